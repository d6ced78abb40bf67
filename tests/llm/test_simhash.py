from collections import Counter

import numpy as np
import xxhash

from tidelog.llm import simhash


def slow_print(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(prints):
    label = {p: p for p in prints}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a in prints:
        for b in prints:
            if (a ^ b).bit_count() <= 3:
                label[find(a)] = find(b)
    return {p: find(p) for p in prints}


def check(docs):
    rows = docs.collect()
    prints = [slow_print(r.text) for r in rows]
    roots = slow_components(set(prints))
    least = {}
    for r, p in zip(rows, prints):
        if r.doc_id is not None:
            least[roots[p]] = min(least.get(roots[p], r.doc_id), r.doc_id)
    expected = Counter((r.doc_id, f"{p:016x}", least.get(roots[p])) for r, p in zip(rows, prints))
    assert Counter(map(tuple, simhash.simhash_dedup(docs).collect())) == expected
    return len(least) + any(roots[p] not in least for p in prints)


def test_agrees_with_brute_force(odd, documents):
    check(odd)
    groups = check(documents)
    kept = simhash.simhash_dedup(documents, whole_rows=True).where("kept").select("row.*")
    assert kept.columns == documents.columns and kept.count() == groups
    assert simhash.simhash_dedup(odd.limit(0)).count() == 0


def test_long_texts_in_parts(monkeypatch):
    text = " ".join(f"w{i % 97}" for i in range(500))
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "PART_BYTES", 7)
    assert simhash.fingerprint(text) == whole == slow_print(text)


def test_links_span_every_component(spark, monkeypatch):
    rng = np.random.default_rng(5)
    seeds = rng.integers(0, 1 << 62, 40)
    prints = {int(s) for s in seeds}
    for s in seeds:
        for _ in range(12):
            p = int(s)
            for b in rng.integers(0, 63, rng.integers(1, 7)):
                p ^= 1 << int(b)
            prints.add(p)
    prints = sorted(prints)
    frame = spark.createDataFrame([(p,) for p in prints], "fp long")
    for probe_from in (2_400, 2):
        monkeypatch.setattr(simhash, "PROBE_FROM", probe_from)
        found = {r.node: r.root for r in simhash.components(simhash.links(frame)).collect()}
        slow = slow_components(prints)
        least = {}
        for p in prints:
            least[slow[p]] = min(p, least.get(slow[p], p))
        assert all(found.get(p, p) == least[slow[p]] for p in prints)
