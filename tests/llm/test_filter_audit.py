import random
import re
from collections import defaultdict
from itertools import permutations

import pytest

from surveyloom.llm import filter_audit
from surveyloom.llm.filter_audit import Diagram, Weight, audit_part, neighbour_swaps


def _fails(rows):
    """(part, set of letters, doc_id) of every row by plain Python; rows: (doc_id, text, lang)."""
    first = {}
    for doc_id, text, _ in rows:
        if doc_id is not None:
            first[text or ""] = min(first.get(text or "", doc_id), doc_id)
    found = []
    for doc_id, text, lang in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        tests = (
            len(words) < 100,
            100 * len(set(words)) < 80 * len(words),
            100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
            bool(re.search("[#$%&*|]", text)),
            doc_id is not None and first[text] < doc_id,
        )
        found.append((lang or "", {letter for letter, failed in zip("ABCDE", tests) if failed}, doc_id))
    return found


def _audit(rows, good, toxic):
    """Every cascade, run document by document."""
    parts = defaultdict(list)
    for part, fails, doc_id in _fails(rows):
        parts[part].append((fails, doc_id))
    wanted = []
    for part, members in parts.items():
        steps, removed_by = [], defaultdict(int)
        for order in permutations("ABCDE"):
            left = members
            for step, letter in enumerate(order, 1):
                removed = [d for d in left if letter in d[0]]
                left = [d for d in left if letter not in d[0]]
                failing = sum(letter in d[0] for d in members)
                removed_by[letter] += len(removed)
                steps.append(("".join(order), step, letter, len(left), len(removed), failing - len(removed), removed))
        for order, step, letter, kept, n, redundant, removed in steps:
            alone = sum(fails == {letter} for fails, _ in members)
            lost = [sum(d in marked for _, d in removed) for marked in (good, toxic)]
            wanted.append((part, order, step, kept, n, redundant, alone, *lost, removed_by[letter]))
    return wanted


def _rows(frame):
    columns = [c.split()[0] for c in filter_audit._STEPS.split(", ")]
    return sorted(tuple(row[c] for c in columns) for row in frame.collect())


def _brute(docs, labels):
    marks = [(r.doc_id, r.quality, r.toxic) for r in labels.collect()]
    good, toxic = {d for d, q, _ in marks if q == 1}, {d for d, _, t in marks if t == 1}
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang").collect()]
    return sorted(_audit(rows, good - {None}, toxic - {None}))


def test_the_query_equals_running_every_cascade(spark, small, docs):
    labels = spark.read.parquet(f"{small}/labels.parquet")
    assert _rows(filter_audit.filter_audit(docs, labels)) == _brute(docs, labels)


def test_the_query_equals_its_sql(spark, small, docs, database, same_rows):
    labels = spark.read.parquet(f"{small}/labels.parquet")
    same_rows(filter_audit.filter_audit(docs, labels), database.sql(filter_audit.AUDIT_SQL))


def test_odd_documents(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 1), (1, 0, 1), (2, None, 1), (3, 1, None), (None, 1, 1), (6, 1, 0), (999, 1, 1)], "doc_id long, quality int, toxic int")
    assert _rows(filter_audit.filter_audit(odd_docs, labels)) == _brute(odd_docs, labels)
    assert _rows(filter_audit.filter_audit(odd_docs, labels.limit(0))) == _brute(odd_docs, labels.limit(0))
    assert filter_audit.filter_audit(no_docs, labels).count() == 0


def test_copies_across_parts_and_ids(spark):
    rows = [(5, "same $", "en"), (5, "same $", "de"), (3, "same $", "fr"), (None, "same $", "en"), (9, None, "en"), (8, "", "en"), (7, "", None), (2, "ÄÖ AB", "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(5, 1, 0), (9, 0, 1)], "doc_id long, quality int, toxic int")
    found = filter_audit.failures(docs)
    assert sorted((r.part, r.mask >> 4) for r in found.collect()) == [("", 0), ("", 0), ("de", 1), ("en", 0), ("en", 1), ("en", 1), ("en", 1), ("fr", 0)]
    assert _rows(filter_audit.filter_audit(docs, labels)) == _brute(docs, labels)


@pytest.mark.parametrize("size", [1, 2, 3, 5])
def test_neighbour_swaps_reach_every_order_once(size):
    order, seen = list(range(size)), [tuple(range(size))]
    for level in neighbour_swaps(size):
        order[level], order[level + 1] = order[level + 1], order[level]
        seen.append(tuple(order))
    assert sorted(seen) == sorted(permutations(range(size)))


def test_swaps_keep_the_diagram_reduced():
    """After any swaps the diagram is the one built in that order: same paths, same number of nodes that are reached."""
    rng = random.Random(3)
    weights = {mask: Weight(rng.randint(1, 3), rng.randint(0, 1), 0) for mask in rng.sample(range(32), 14)}
    diagram = Diagram(weights, 5)
    for _ in range(60):
        diagram.swap(rng.randrange(4))
        moved = {}
        for mask, weight in weights.items():
            at = sum(1 << i for i, name in enumerate(diagram.order) if mask >> name & 1)
            moved[at] = weight
        fresh = Diagram(moved, 5)
        assert fresh.steps() == diagram.steps()
        assert _reached(fresh) == _reached(diagram)


def _reached(diagram):
    seen, todo = set(), [diagram.root]
    while todo:
        node = todo.pop()
        if node not in seen:
            seen.add(node)
            todo.extend(diagram.nodes[node][1:] if len(diagram.nodes[node]) == 3 else ())
    return len(seen)


def test_any_number_of_filters():
    weights = {mask: Weight(mask + 1, mask & 1, 0) for mask in range(8)}
    rows = audit_part(weights, "XYZ")
    assert len(rows) == 6 * 3
    for order, _, kept, *_ in rows:
        if _ == 3:
            assert kept == 1
    assert audit_part({0: Weight(4, 0, 0)}, "X") == [("X", 1, 4, 0, 0, 0, 0, 0, 0)]
