import random
from collections import Counter, defaultdict

import pytest

from cadenza.llm import packing as P

SCHEMA = "tokenizer string, doc_id long, n_tokens int, size int, part int"


@pytest.mark.parametrize("capacity", [1, 2, 16, 257, 2048, 50_000])
def test_plan_holds_all_and_wastes_little(capacity):
    r = random.Random(capacity)
    h = Counter(max(1, min(capacity, round(r.lognormvariate(0, 1.2) * capacity / 6))) for _ in range(4000))
    p = P.plan(dict(h), capacity)
    held, given = Counter(), Counter()
    for size, lo, hi, first, copies in p.rows:
        given[size] += hi - lo
        for b in range(first, first + (hi - lo) // copies):
            held[b] += size * copies
    assert given == h
    assert max(held.values()) <= capacity and len(held) == p.n
    assert p.n <= -(-sum(s * c for s, c in h.items()) // capacity) * 1.01 + 2


def test_ranks_of_a_size_are_given_once():
    p = P.plan({5: 1000, 3: 400, 9: 77}, 10)
    for size, n in ((5, 1000), (3, 400), (9, 77)):
        spans = sorted((lo, hi) for s, lo, hi, _, _ in p.rows if s == size)
        assert spans[0][0] == 0 and spans[-1][1] == n and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))


def test_pack(spark):
    r = random.Random(1)
    sizes = [0, 0, 0, 10, 25, 100] + [r.choice([0, 1, 3, 7, 7, 7, 10, 23]) for _ in range(500)]
    df = spark.createDataFrame([("t", i, n, 1, 2) for i, n in enumerate(sizes)] + [("u", 1, 4, 1, 2)], SCHEMA)
    for part_rows in (1_000_000, 40):
        rows = P.pack(df, [("t", 10), ("t", 25), ("u", 3), ("w", 9)], part_rows).collect()
        held, docs = Counter(), defaultdict(dict)
        for x in rows:
            held[x.tokenizer, x.capacity, x.container_id] += x.n_tokens
            docs[x.tokenizer, x.capacity, x.doc_id][x.piece] = x.n_tokens
        assert all(n <= k[1] for k, n in held.items())
        for (t, cap, doc), pieces in docs.items():
            n = 4 if t == "u" else sizes[doc]
            assert sum(pieces.values()) == n and sorted(pieces) == list(range(len(pieces)))
            assert len(pieces) == 1 if n <= cap else len(pieces) == -(-n // cap)
        assert len(docs) == 2 * len(sizes) + 1
        assert len(rows) == sum(len(p) for p in docs.values())
    fill = {(x.tokenizer, x.capacity): x for x in P.fill(P.pack(df, [("t", 25)])).collect()}
    rooms = []  # first fit of descending sizes, item by item
    for n in sorted((x for s in sizes for x in [25] * (s // 25) + [s % 25] if x), reverse=True):
        at = next((i for i, room in enumerate(rooms) if room >= n), None)
        if at is None:
            rooms.append(25 - n)
        else:
            rooms[at] -= n
    assert fill["t", 25].n_containers <= len(rooms) * 1.02 + 1 and fill["t", 25].most <= 25


def test_only_empty_documents_and_nothing(spark):
    df = spark.createDataFrame([("t", i, 0, 1, 1) for i in range(5)], SCHEMA)
    assert {x.container_id for x in P.pack(df, [("t", 8)]).collect()} == {0}
    assert P.pack(df.limit(0), [("t", 8)]).count() == 0
    assert P.pack(df, []).count() == 0


def test_specs(spark):
    df = spark.createDataFrame([("a", 5), ("a", 5), (None, 3), ("b", 0), ("b", None)], "tokenizer string, capacity int")
    assert P.specs_of(df) == [("a", 5)]
    many = spark.sql("SELECT 'a' AS tokenizer, cast(id + 1 as int) AS capacity FROM range(10005)")
    with pytest.raises(ValueError):
        P.specs_of(many)
    assert len(P.specs_of(many.where("capacity <= 10000"))) == 10_000


def test_configurations_hold_every_large_item():
    """Per capacity: no large item by best-fit, and about as few containers as best-fit of descending sizes takes."""
    r = random.Random(11)
    for capacity in (256, 1024, 5000):
        h = Counter(max(1, min(capacity, round(r.lognormvariate(0, 1.1) * capacity / 5))) for _ in range(6000))
        p = P.plan(dict(h), capacity)
        inside = Counter()
        for size, lo, hi, first, _ in p.rows:
            if first < p.configured:
                inside[size] += hi - lo
        assert all(inside[s] == n for s, n in h.items() if s > max(P.LARGE) * capacity)
        plain = P.Plan(capacity)
        for size in sorted(h, reverse=True):
            plain.best_fit(size, h[size])
        assert p.n <= plain.n * 1.002, capacity


def test_counts_of_all_vocabularies_at_once(spark):
    from cadenza.llm import encode as E

    texts = [None, "", "a b", "the frogs jump. " * 600, "the frogs jump. " * 600, "ก" * 5000, "short"]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, n0 string")
    names = ["byte_bpe_50k", "byte_bpe_multi_50k", "piece_bpe_32k", "word_bpe_49k"]
    got = {(x.tokenizer, x.doc_id): x.n_tokens for x in E.count_tokens(df, "doc_id", "text", names).collect()}
    assert got == {(n, i): len(ids) for n in names for i, ids in enumerate(E.encoder(n, E.FOLDER)([t or "" for t in texts]))}
    few = E.count_tokens(df, "doc_id", "text", ["piece_bpe_32k"]).collect()
    assert {(x.tokenizer, x.doc_id): x.n_tokens for x in few} == {k: v for k, v in got.items() if k[0] == "piece_bpe_32k"}
    assert E.count_tokens(df.limit(0), "doc_id", "text", names).count() == 0
