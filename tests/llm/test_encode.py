import random

from cadenza.llm import encode as E

SCHEMA = "doc_id long, text string, digest string, ids string, j int"


def texts():
    r = random.Random(4)
    parts = ["hello world ", "don't ", "\n\n", "   ", "\n \n", "日本語の文章。", "ภาษาไทย ", "😀👩‍🏫", "x" * 40, "123 456", "<|endoftext|>", "é é ", " ", "।", "a"]
    out = [None, "", " ", "a", "\n" * 300, "z" * 1000, "漢" * 700, " " * 500 + "end"]
    out += ["".join(r.choice(parts) for _ in range(r.randint(1, 200))) for _ in range(60)]
    return out + out[-5:]


def test_pieces_equal_the_whole(spark):
    t = texts()
    df = spark.createDataFrame([(i, x, "d", "i", 1) for i, x in enumerate(t)], SCHEMA)
    for name in E.BYTE_LEVEL:
        want = E.encoder(name, E.FOLDER)([x or "" for x in t])
        for chunk, overlap in ((4096, 256), (64, 16), (20, 5)):
            got = {r.doc_id: list(r.ids) for r in E.encode_texts(df, "doc_id", "text", name, chunk=chunk, overlap=overlap).collect()}
            assert got == dict(enumerate(want)), (name, chunk)
        counts = {r.doc_id: r.n_tokens for r in E.encode_texts(df, "doc_id", "text", name, count=True, chunk=64, overlap=16).collect()}
        assert counts == {i: len(x) for i, x in enumerate(want)}


def test_long_texts_are_cut(spark):
    df = spark.createDataFrame([("d", "one two three. " * 2000)], "digest string, text string")
    n = E._pieces(df, 4096, 256).count()
    assert n == 8


def test_round_trip_and_other_vocabularies(spark):
    t = texts()
    df = spark.createDataFrame([(i, x, "d", "i", 1) for i, x in enumerate(t)], SCHEMA)
    assert {r.doc_id: r.text for r in E.decoded(df, "byte_bpe_50k").collect()} == {i: x or "" for i, x in enumerate(t)}
    for name in ("word_bpe_49k", "piece_bpe_32k"):
        got = {r.doc_id: list(r.ids) for r in E.encode_texts(df, "doc_id", "text", name).collect()}
        assert got == dict(enumerate(E.encoder(name, E.FOLDER)([x or "" for x in t])))
        assert got[0] == got[1] == []


def test_repeated_and_null_ids_and_empty(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, None), (2, "q w " * 3000), (2, "q w " * 3000)], "doc_id long, text string")
    got = sorted((r.doc_id or 0, len(r.ids)) for r in E.encode_texts(df, "doc_id", "text", "byte_bpe_50k").collect())
    assert [x for x, _ in got] == [0, 1, 1, 2, 2] and got[0][1] == 0 and got[3] == got[4]
    spread = E.encode_texts(df, "doc_id", "text", "byte_bpe_50k", hot_rows=1)
    assert sorted((r.doc_id or 0, len(r.ids)) for r in spread.collect()) == got
    assert E.encode_texts(df.limit(0), "doc_id", "text", "byte_bpe_50k").count() == 0
