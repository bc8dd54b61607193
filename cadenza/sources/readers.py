"""Sources with explicit schemas."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyspark.sql.types as T
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.functions.sequences import parse_list

ACTIVITY = T.StructType([T.StructField(n, T.TimestampNTZType() if n == "createdat" else T.StringType()) for n in ("activityid", "storyid", "studentid", "districtid", "type", "createdat", "status", "displaystatus")])
STORY_TEXT = T.StructType([T.StructField("storyId", T.StringType()), T.StructField("phraseIndex", T.IntegerType()), T.StructField("expected_text", T.StringType()), T.StructField("reference_phonemes", T.StringType())])
WORD = "struct<word:string,start:double,end:double,confidence:double>"
JOB = T.StructType([T.StructField("activity_id", T.StringType()), T.StructField("story_id", T.StringType()), T.StructField("student_id", T.StringType()), T.StructField("created_at", T.StringType()), T.StructField("source", T.StringType()), T.StructField("timestamp", T.LongType())])


def read_file(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet or CSV (with a header) by suffix; any other suffix is a ValueError."""
    if path.endswith(".parquet"):
        return spark.read.schema(schema).parquet(path) if schema else spark.read.parquet(path)
    if path.endswith(".csv"):
        if schema is None:
            raise ValueError("a CSV file needs a schema")
        return spark.read.schema(schema).option("header", True).option("quote", '"').option("escape", '"').csv(path)
    raise ValueError(f"unknown format: {path}")


def read_story_phrases(spark: SparkSession, path: str) -> DataFrame:
    """Phrases whose lists are literal strings in CSV, or arrays in Parquet."""
    df = read_file(spark, path, STORY_TEXT if path.endswith(".csv") else None)
    lists = [c for c in ("expected_text", "reference_phonemes") if c in df.columns and dict(df.dtypes)[c] == "string"]
    return df.withColumns({c: parse_list(F.col(c)) for c in lists})


def filtered(df: DataFrame, condition, n: int = 10) -> DataFrame:
    """At most n rows that meet the condition: a look into a source."""
    return df.where(condition).limit(n)


def describe(spark: SparkSession, df: DataFrame) -> DataFrame:
    """(name, type, nullable) of the columns."""
    return spark.createDataFrame([(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema], "name string, type string, nullable boolean")


def describe_catalog(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """(table, name, type, place) of the columns of named tables, as a catalog lists them; place counts from 0. From the schemas alone."""
    rows = [(t, f.name, f.dataType.simpleString(), i) for t, df in tables.items() for i, f in enumerate(df.schema)]
    return spark.createDataFrame(rows, "table string, name string, type string, place int")


def read_pages(spark: SparkSession, pattern: str) -> DataFrame:
    """(story, page_index, words, text) of files <story>_<n>_page.txt with one word a line; blank lines are dropped."""
    lines = spark.read.text(pattern, wholetext=True).select("value", F.input_file_name().alias("file"))
    name = F.element_at(F.split("file", "/"), -1)
    rx = r"^(.+)_(\d+)_page\.txt$"
    words = F.filter(F.transform(F.split("value", r"\r?\n"), lambda w: F.trim(w)), lambda w: w != "")
    return lines.where(name.rlike(rx)).select(F.regexp_extract(name, rx, 1).alias("story"), F.regexp_extract(name, rx, 2).cast("int").alias("page_index"), words.alias("words"), F.array_join(words, " ").alias("text"))


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """(word, phonemes) of lines with at least two fields; of repeated words the last line wins. A dictionary is one small file."""
    lines = spark.read.text(path).select(F.monotonically_increasing_id().alias("n"), F.split(F.trim("value"), r"\s+", 2).alias("p"))
    return lines.where(F.size("p") > 1).groupBy(F.get("p", F.lit(0)).alias("word")).agg(F.max_by(F.get("p", F.lit(1)), "n").alias("phonemes"))


def read_thresholds(spark: SparkSession, path: str) -> DataFrame:
    """(model, threshold) of <model>/…/metadata.json files."""
    df = spark.read.schema("properties struct<threshold:double>").option("multiLine", True).json(path)
    model = F.regexp_extract(F.input_file_name(), r"([^/]+)/(?:assets/)?metadata\.json$", 1)
    return df.select(model.alias("model"), F.col("properties.threshold").alias("threshold"))


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Segment rows of JSON manifests, in lines or as one document a file; path may be a pattern over activities."""
    return spark.read.schema("activityId string, phraseIndex int, start_ms double, end_ms double, s3_uri string").json(path)


def manifest_path(root: str, activity: str = "*", name: str = "manifest") -> str:
    """Where the manifest of an activity (or of all) lies, under either of its names."""
    return f"{root.rstrip('/')}/{activity}/{name}.json"


def list_objects(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(key, size, modified) under a path; the contents are not read."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path).select(F.col("path").alias("key"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def valid_keys(listing: DataFrame) -> DataFrame:
    """Keys of a listing that are there, as strings."""
    return listing.where(F.col("Key").isNotNull()).select(F.col("Key").cast("string").alias("key"))


def read_wav(spark: SparkSession, path: str) -> DataFrame:
    """(key, channels, rate, bits, data_bytes, duration_ms) from the 44-byte header; a file of at most a header has duration 0."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.wav").load(path)
    number = lambda at, n: F.conv(F.array_join(F.reverse(F.transform(F.sequence(F.lit(at), F.lit(at + n - 1)), lambda i: F.hex(F.substring(F.col("content"), i, F.lit(1))))), ""), 16, 10).cast("bigint")
    data = F.greatest(F.col("length") - 44, F.lit(0))
    df = files.select(F.col("path").alias("key"), number(23, 2).alias("channels"), number(25, 4).alias("rate"), number(35, 2).alias("bits"), data.alias("data_bytes"))
    per_ms = F.col("rate") * F.col("channels") * F.col("bits") / 8000
    return df.withColumn("duration_ms", F.when(F.col("data_bytes") > 0, F.try_divide("data_bytes", per_ms)).otherwise(0.0))


def wav_samples(content: Column, rate: int = 16_000) -> Column:
    """Struct (channels, rate, bits, data_bytes, samples) of a WAV file's bytes, by a walk over its chunks.

    samples: 16-bit mono values as floats from -1 to 1, linearly interpolated to
    rate. Bytes that are no WAV, other sample sizes and files without data have
    null fields and no samples; a data chunk that is cut short ends with the file.
    """

    @F.pandas_udf("channels int, rate int, bits int, data_bytes bigint, samples array<float>")
    def walk(files: pd.Series) -> pd.DataFrame:
        rows = []
        for b in files:
            channels = hz = bits = size = None
            samples: list[float] | np.ndarray = []
            if b is not None and b[:4] == b"RIFF" and b[8:12] == b"WAVE":
                at = 12
                while at + 8 <= len(b):
                    name, n = b[at : at + 4], int.from_bytes(b[at + 4 : at + 8], "little")
                    body = b[at + 8 : at + 8 + n]
                    if name == b"fmt " and len(body) >= 16:
                        channels, hz, bits = (int.from_bytes(body[i:j], "little") for i, j in ((2, 4), (4, 8), (14, 16)))
                    elif name == b"data":
                        size = len(body)
                        if bits == 16 and channels and hz:
                            x = np.frombuffer(body[: size - size % (2 * channels)], "<i2").reshape(-1, channels).mean(axis=1) / 32768
                            m = round(len(x) * rate / hz)
                            samples = np.interp(np.arange(m) * hz / rate, np.arange(len(x)), x).astype("float32") if len(x) else []
                    at += 8 + n + n % 2
            rows.append((channels, hz, bits, size, samples))
        out = pd.DataFrame(rows, columns=["channels", "rate", "bits", "data_bytes", "samples"])
        return out.astype({"channels": "Int32", "rate": "Int32", "bits": "Int32", "data_bytes": "Int64"})

    return walk(content)


def best_alternative(response: Column) -> Column:
    """Struct (transcript, confidence) of a recogniser's JSON: the first alternative of the first channel, null if there is none."""
    kind = "results struct<channels:array<struct<alternatives:array<struct<transcript:string,confidence:double>>>>>"
    return F.get(F.get(F.from_json(response, kind)["results"]["channels"], F.lit(0))["alternatives"], F.lit(0))


def transcript_words(text: Column) -> Column:
    """Words of a recogniser's response: of more than two lines the last but one, else the whole; its data[0].text list."""
    lines = F.split(text, "\n")
    body = F.when(F.size(lines) > 2, F.element_at(lines, -2)).otherwise(text)
    return F.from_json(body, f"data array<struct<text:array<{WORD}>>>")["data"][0]["text"]
