"""Raw edition columns to the conformed table, by declared rules.

An edition is a mapping of conformed column to rule. Every rule is a plain expression, so an
edition is a projection: no row is dropped, merged or moved. A question that an edition did
not ask has no rule and is NULL. Answers with many spellings are looked up by a join with a table of spellings, in which each
spelling is there once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.functions import quoted, to_number, whole_number
from surveyloom.vocabulary import SILVER_TYPES

PROCESSED_AT = "processado_em"
DERIVED = ("flag_ia_contraditoria", "quantidade_flags_qualidade")
ACCESS_FLAGS = ("ia_gratuita", "ia_paga_propria", "ia_paga_empresa", "ia_copilot")
QUALITY_COLUMNS = ("senioridade", "regiao_moradia", "salario_ponto_medio")


def _text(source: str) -> Column:
    """The trimmed answer; a blank answer is NULL."""
    answer = F.trim(quoted(source))
    return F.nullif(answer, F.lit(""))


#: A map of this many entries is searched one entry after another in every row; larger ones are joined.
MOST_LITERALS = 50
SPELLING, VALUE = "grafia", "valor"

#: Raw answer -> what it stands for: in the code, or a table (grafia, valor).
Spellings = Mapping[str, object] | DataFrame


def _found(mapping: Mapping[str, object], key: Column) -> Column:
    entries = [F.lit(item) for pair in mapping.items() for item in pair]
    return F.try_element_at(F.create_map(*entries), key)


def _is_joined(spellings: Spellings) -> bool:
    return isinstance(spellings, DataFrame) or len(spellings) > MOST_LITERALS


def spelling_table(spark: SparkSession, spellings: Spellings) -> DataFrame:
    """grafia, valor: one row for each trimmed spelling. Of several values for one spelling the least counts; blank spellings go."""
    if not isinstance(spellings, DataFrame):
        return spark.createDataFrame(list(spellings.items()), [SPELLING, VALUE])
    trimmed = F.nullif(F.trim(F.col(SPELLING)), F.lit("")).alias(SPELLING)
    return spellings.select(trimmed, VALUE).filter(F.col(SPELLING).isNotNull()).groupBy(SPELLING).agg(F.min(VALUE).alias(VALUE))


@dataclass(frozen=True)
class Answer:
    """Text, respelled where the mapping says so. Unknown spellings stay, for the audit to count."""

    source: str
    spellings: Spellings = field(default_factory=dict)

    def column(self, joined: Column | None = None) -> Column:
        text = _text(self.source)
        if joined is not None:
            return F.coalesce(joined, text)
        return F.coalesce(_found(self.spellings, text), text) if self.spellings else text


@dataclass(frozen=True)
class Code:
    """A value looked up by the raw answer; NULL for answers that are not listed."""

    source: str
    values: Spellings

    def column(self, joined: Column | None = None) -> Column:
        return _found(self.values, _text(self.source)) if joined is None else joined


@dataclass(frozen=True)
class Number:
    """A number; a whole one may be written with decimals."""

    source: str

    def column(self) -> Column:
        text = _text(self.source)
        return F.coalesce(whole_number(text).cast("string"), text)


@dataclass(frozen=True)
class Flag:
    """0 or 1; anything else is "not asked". Read with all other flags of the edition, see `_flag_values`."""

    source: str

    def column(self, joined: Column) -> Column:
        return joined


FLAG_VALUES = "_marcas"


def _flag_values(sources: Sequence[str]) -> Column:
    """One array of all flags, in order, so that their steps are there once.

    Written out for every flag they make a method of over 8,000 bytes, which Java does not compile but interprets in every row.
    """

    def number(text: Column) -> Column:
        # Most answers are one digit, which needs no pattern.
        return F.when(text == "0", 0.0).when(text == "1", 1.0).otherwise(to_number(text))

    texts = F.array(*[quoted(source).cast("string") for source in sources])
    numbers = F.transform(F.transform(texts, lambda text: F.trim(text)), number)
    return F.transform(numbers, lambda value: F.when(value.isin(0.0, 1.0), value))


Rule = Answer | Code | Number | Flag


def conform(bronze: DataFrame, year: int, rules: Mapping[str, Rule], processed_at: datetime) -> DataFrame:
    """One edition in the conformed columns, stamped with the time of the run."""
    unknown = set(rules) - set(SILVER_TYPES)
    if unknown:
        raise ValueError(f"Rules for columns that are not conformed: {sorted(unknown)}")

    joined: dict[str, Column] = {}
    for name, rule in rules.items():
        spellings = rule.spellings if isinstance(rule, Answer) else rule.values if isinstance(rule, Code) else {}
        if _is_joined(spellings):
            key, value = f"_{SPELLING}_{name}", f"_{VALUE}_{name}"
            table = spelling_table(bronze.sparkSession, spellings).toDF(key, value)
            # No hint: Spark broadcasts the table by its size, and else splits the partition of a frequent answer.
            bronze = bronze.join(table, _text(rule.source) == F.col(key), "left")
            joined[name] = F.col(value)

    flags = {name: rule.source for name, rule in rules.items() if isinstance(rule, Flag)}
    if flags:
        bronze = bronze.withColumn(FLAG_VALUES, _flag_values(list(flags.values())))
        joined |= {name: F.get(FLAG_VALUES, F.lit(place)) for place, name in enumerate(flags)}

    def target(name: str, kind: str) -> Column:
        if name == "ano_pesquisa":
            value = F.lit(year)
        elif name in joined:
            value = rules[name].column(joined[name])
        elif name in rules:
            value = rules[name].column()
        else:
            value = F.lit(None)
        return value.try_cast(kind).alias(name)

    answers = bronze.select(*[target(n, k) for n, k in SILVER_TYPES.items() if n not in DERIVED])
    contradicted = (F.col("usa_ia_generativa") == 0) & (F.greatest(*ACCESS_FLAGS) == 1)
    gaps = " + ".join(f"int({name} IS NULL)" for name in QUALITY_COLUMNS)
    return answers.withColumns(
        {
            "flag_ia_contraditoria": F.when(contradicted, 1).otherwise(0),
            "quantidade_flags_qualidade": F.expr(gaps),
            PROCESSED_AT: F.lit(processed_at),
        }
    )
