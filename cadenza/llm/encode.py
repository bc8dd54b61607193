"""Encoding of a corpus with a public tokenizer.

A long text is cut into overlapping chunks that are pre-tokenised in parallel.
Where a pre-token boundary of one chunk recurs in the overlap of the next, the
two have resynchronised: the pattern looks ahead only, so from there on both
agree. The text is cut at these places, the pieces are encoded in parallel and
their ids put together again. Decoding concatenates the raw bytes of the ids.
"""

from __future__ import annotations

import base64
import functools
import os
from collections.abc import Iterator

import pandas as pd
import pyspark.sql.types as T
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.plans.skew import HOT_ROWS, skew_join

#: Folder of the vocabulary files, on every executor.
FOLDER = "/opt/tokenizers"
# Fixed value: the pre-tokenising pattern of the byte-level vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Vocabularies whose text can be cut at pre-token boundaries.
BYTE_LEVEL = ("byte_bpe_50k", "byte_bpe_multi_50k")


@functools.lru_cache(maxsize=4)
def _ranks(name: str, folder: str) -> dict[bytes, int]:
    with open(os.path.join(folder, f"{name}.tiktoken"), "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f)}


@functools.lru_cache(maxsize=4)
def encoder(name: str, folder: str):
    """texts -> lists of ids, without special tokens; loaded once a worker."""
    if name in BYTE_LEVEL:
        import tiktoken

        enc = tiktoken.Encoding(name, pat_str=PATTERN, mergeable_ranks=_ranks(name, folder), special_tokens={})
        return lambda texts: [enc.encode_ordinary(t) for t in texts]
    if os.path.exists(path := os.path.join(folder, f"{name}.model")):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: sp.encode(texts, num_threads=1)
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tok = Tokenizer.from_file(os.path.join(folder, f"{name}.json"))
    tok.encode_special_tokens = True
    return lambda texts: [e.ids for e in tok.encode_batch(texts, add_special_tokens=False)]


def _encode_udf(name: str, folder: str, count: bool):
    @F.pandas_udf(T.IntegerType() if count else T.ArrayType(T.IntegerType()))
    def encode(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = encoder(name, folder)
        for s in parts:
            texts = s.fillna("").tolist()
            ids = enc(texts) if texts else []
            yield pd.Series([len(i) for i in ids], dtype="int32") if count else pd.Series(ids, dtype=object)

    return encode


@functools.lru_cache(maxsize=1)
def _pattern():
    import regex

    return regex.compile(PATTERN)


def sync_points(text: str, start: int, first: bool, last: bool, chunk: int, overlap: int) -> tuple[list[int], list[int]]:
    """Pre-token boundaries of a chunk that begins at start, in its leading and in its trailing overlap.

    Only boundaries after a character that is not white space: there the look-ahead
    of the pattern has no say, so both sides of a cut are tokenised as in the whole
    text. A boundary at the chunk's end is one only at the text's end.
    """
    head, tail, end = [], [], len(text)
    for m in _pattern().finditer(text):
        e = m.end()
        if e == end:
            break
        if text[e - 1].isspace():
            continue
        if not first and e < overlap:
            head.append(start + e)
        if not last and e >= chunk:
            tail.append(start + e)
    return head, tail


def _sync_udf(chunk: int, overlap: int):
    @F.pandas_udf("head array<int>, tail array<int>")
    def sync(text: pd.Series, start: pd.Series, n: pd.Series) -> pd.DataFrame:
        out = [sync_points(t, s, s == 0, s + len(t) >= m, chunk, overlap) for t, s, m in zip(text, start, n)]
        return pd.DataFrame({"head": [o[0] for o in out], "tail": [o[1] for o in out]}, dtype=object)

    return sync


def _chunks_udf(chunk: int, overlap: int):
    # in Python, since finding a place in a long text takes the JVM time in proportion to the place
    @F.pandas_udf("array<string>")
    def cut(text: pd.Series) -> pd.Series:
        return pd.Series([[t[i : i + chunk + overlap] for i in range(0, len(t), chunk)] for t in text], dtype=object)

    return cut


def _cut_at(text: str, cuts: str) -> Column:
    @F.pandas_udf("array<string>")
    def cut(t: pd.Series, c: pd.Series) -> pd.Series:
        return pd.Series([[x[a:b] for a, b in zip(at, at[1:])] for x, at in zip(t, c)], dtype=object)

    return cut(text, cuts)


def _pieces(long: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """(digest, j, text): the texts of long (digest unique, text) cut where neighbouring chunks resynchronise."""
    n = F.char_length("text")
    chunks = long.select("digest", n.alias("n"), F.posexplode(_chunks_udf(chunk, overlap)("text")).alias("i", "piece")).withColumn("start", F.col("i") * chunk)
    # one long text keeps many tasks busy
    chunks = chunks.repartition("digest", "i").select("digest", "n", "i", _sync_udf(chunk, overlap)("piece", "start", "n").alias("s"))
    ends = chunks.groupBy("digest").agg(F.first("n").alias("n"), F.array_sort(F.collect_list(F.struct("i", "s.head", "s.tail"))).alias("c"))
    # where two chunks share no boundary they stay one piece
    cut = lambda i: F.array_min(F.array_intersect(F.get("c", i - 1)["tail"], F.get("c", i)["head"]))
    inner = F.when(F.size("c") > 1, F.filter(F.transform(F.sequence(F.lit(1), F.size("c") - 1), cut), lambda x: x.isNotNull())).otherwise(F.array().cast("array<int>"))
    cuts = F.array_distinct(F.concat(F.array(F.lit(0)), inner, F.array(F.col("n"))))
    at = ends.select("digest", cuts.alias("cuts"))
    both = long.join(at, "digest").select("digest", F.posexplode(_cut_at("text", "cuts")).alias("j", "piece"))
    return both.repartition("digest", "j")


def bound_batches(spark) -> None:
    """Let Arrow batches end at 16 MB where the session sets no bound of its own: long texts come in few rows. Other settings stay."""
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) in (None, "", "-1", str(2**31 - 1), str(2**63 - 1)):
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


def encode_texts(df: DataFrame, row_id: str, text: str, tokenizer: str, folder: str = FOLDER, count: bool = False, chunk: int = 4096, overlap: int = 256, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(row_id, ids), or (row_id, n_tokens) with count, of every row of df.

    Null and empty texts have the empty list (0 tokens). Repeated rows and
    repeated ids come out as often as they are there; ids may be null. Special
    tokens' strings are ordinary text. Texts of more than chunk + overlap code
    points are encoded in pieces, each distinct one once; for vocabularies that
    are not byte-level a text is one piece. Other columns are not looked at.
    """
    bound_batches(df.sparkSession)
    name = "n_tokens" if count else "ids"
    run = _encode_udf(tokenizer, folder, count)
    rows = df.select(F.col(row_id).alias(row_id), F.col(text).alias("text"))
    if tokenizer not in BYTE_LEVEL:
        return rows.select(row_id, run("text").alias(name))
    is_long = F.coalesce(F.char_length("text") > chunk + overlap, F.lit(False))
    short = rows.where(~is_long).select(row_id, run("text").alias(name))
    long = rows.where(is_long).withColumn("digest", F.sha2("text", 256))
    done = _pieces(long.dropDuplicates(["digest"]).select("digest", "text"), chunk, overlap).select("digest", "j", run("piece").alias(name))
    if count:
        whole = done.groupBy("digest").agg(F.sum(name).cast("int").alias(name))
    else:
        whole = done.groupBy("digest").agg(F.array_sort(F.collect_list(F.struct("j", name))).alias("p")).select("digest", F.flatten(F.transform("p", lambda x: x[name])).alias(name))
    # copies of one text may be many: their rows are spread
    return short.unionByName(skew_join(long.select(row_id, "digest"), whole, ["digest"], hot_rows=hot_rows).select(row_id, name))


def _counts_udf(names: list[str], folder: str):
    """Struct of the token counts n0, n1, … of a text by each vocabulary; those for which whole is false are null."""

    @F.pandas_udf(T.StructType([T.StructField(f"n{i}", T.IntegerType()) for i in range(len(names))]))
    def counts(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        run = [encoder(n, folder) for n in names]
        for s, cut in parts:
            texts = s.fillna("").tolist()
            rest = [i for i, c in enumerate(cut) if not c]
            cols = {}
            for i, (name, enc) in enumerate(zip(names, run)):
                at = rest if name in BYTE_LEVEL else range(len(texts))
                n = pd.array([None] * len(texts), "Int32")
                if len(at):
                    n[list(at)] = [len(x) for x in enc([texts[k] for k in at])]
                cols[f"n{i}"] = n
            yield pd.DataFrame(cols)

    return counts


def count_tokens(df: DataFrame, row_id: str, text: str, tokenizers: list[str], folder: str = FOLDER, chunk: int = 4096, overlap: int = 256) -> DataFrame:
    """(tokenizer, row_id, n_tokens) of every row of df under each vocabulary, as many as encode_texts gives ids.

    One pass counts a text under all vocabularies. Long texts are cut once, and
    their pieces counted under all byte-level ones; the others take them whole.
    """
    spark = df.sparkSession
    bound_batches(spark)
    rows = df.select(F.col(row_id).alias(row_id), F.col(text).alias("text"))
    byte_level = [n for n in tokenizers if n in BYTE_LEVEL]
    is_long = F.coalesce(F.char_length("text") > chunk + overlap, F.lit(False)) if byte_level else F.lit(False)
    run = _counts_udf(tokenizers, folder)
    n = [f"n{i}" for i in range(len(tokenizers))]
    each = F.inline(F.array(*[F.struct(F.lit(name).alias("tokenizer"), F.coalesce(c, F.lit(0)).alias("n_tokens")) for name, c in zip(tokenizers, n)]))
    out = rows.where(~is_long).select(row_id, run("text", F.lit(False)).alias("c")).select(row_id, "c.*")
    if byte_level:
        long = rows.where(is_long).withColumn("digest", F.sha2("text", 256))
        once = long.dropDuplicates(["digest"]).select("digest", "text")
        pieces = _pieces(once, chunk, overlap).select("digest", _counts_udf(byte_level, folder)("piece", F.lit(False)).alias("c"))
        whole = pieces.groupBy("digest").agg(*[F.sum(f"c.n{i}").cast("int").alias(f"b{i}") for i in range(len(byte_level))])
        kept = long.select(row_id, "digest", run("text", F.lit(True)).alias("c")).select(row_id, "digest", "c.*")
        both = skew_join(kept, whole, ["digest"])
        cols = [F.col(f"b{byte_level.index(name)}").alias(c) if name in BYTE_LEVEL else F.col(c) for name, c in zip(tokenizers, n)]
        out = out.unionByName(both.select(row_id, *cols))
    return out.select(row_id, each).select("tokenizer", row_id, "n_tokens")


def decode(ids: Column, tokenizer: str, folder: str = FOLDER) -> Column:
    """The raw bytes of byte-level ids as text; null ids give null."""

    @F.pandas_udf(T.StringType())
    def joined(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        token = {i: b for b, i in _ranks(tokenizer, folder).items()}
        for s in parts:
            yield pd.Series([None if x is None else b"".join(token[i] for i in x).decode("utf-8", "replace") for x in s], dtype=object)

    return joined(ids)


def decoded(df: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, text) after encoding and decoding: the text itself, '' for null."""
    return encode_texts(df, "doc_id", "text", tokenizer).select("doc_id", decode(F.col("ids"), tokenizer).alias("text"))


DECODED_SQL = "SELECT doc_id, coalesce(text, '') AS text FROM documents"
