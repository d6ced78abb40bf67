import hashlib
import re
from collections import Counter

import pytest

from tidelog.llm.exact_dedup import exact_dedup


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", r.text or ""), []).append(r)
    out = []
    for norm, members in groups.items():
        order = sorted(members, key=lambda r: (-len(r.text or ""), r.doc_id is None, r.doc_id or 0))
        for place, r in enumerate(order):
            out.append((r.doc_id, order[0].doc_id, len(members), place == 0,
                        hashlib.sha256(norm.encode()).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("capacity", [1, 100_000])
def test_agrees_with_brute_force(odd, documents, capacity):
    for docs in (odd, documents):
        assert Counter(map(tuple, exact_dedup(docs, capacity=capacity).collect())) == brute(docs.collect())


def test_whole_rows_and_empty_table(odd):
    kept = exact_dedup(odd, whole_rows=True).where("kept").select("row.*")
    assert kept.columns == odd.columns
    assert kept.count() == sum(n for k, n in brute(odd.collect()).items() if k[3])
    assert exact_dedup(odd.limit(0)).count() == 0


def test_ids_of_other_types(spark):
    rows = [("b", "x y"), ("a", "xy"), (None, "x y"), ("c", "x y"), ("d", "z"), ("d", "z")]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    found = sorted((str(r.doc_id), r.keep_id, r.group_size, r.kept) for r in exact_dedup(docs).collect())
    assert found == [("None", "b", 4, False), ("a", "b", 4, False), ("b", "b", 4, True), ("c", "b", 4, False),
                     ("d", "d", 2, False), ("d", "d", 2, True)]
