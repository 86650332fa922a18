"""Named frames that are declared when first used."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame

from surveyloom.operators.selection import in_segment


class Frames(Mapping[str, DataFrame]):
    """A read-only mapping of names to frames; an unused frame is never analysed.

    ``parts`` builds a frame restricted to one label of its alternatives, for frames that can be built so.
    """

    def __init__(
        self,
        builders: Mapping[str, Callable[[], DataFrame]],
        parts: Mapping[str, Callable[[str], DataFrame]] | None = None,
    ):
        self._builders = dict(builders)
        self.parts = dict(parts or {})
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


def one_segment(tables: Mapping[str, DataFrame], name: str, label: str, kind: str = "segmento_tipo") -> DataFrame:
    """The cells of one segmentation: built alone where the table is computed, filtered where it is stored."""
    parts = getattr(tables, "parts", {})
    return parts[name](label) if name in parts else in_segment(tables[name], label, kind)
