"""Inverted lists: containment in JSON values and substrings of text, by intersecting the lists asked for, the shortest first."""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

GRAM = 3
#: Rows that a task makes terms of, and ids that are dealt to one file of a bucket, about.
PER_TASK, PER_FILE = 10_000, 50_000


@dataclass(frozen=True)
class Lists:
    """Lists of ids by term under `path`, as rows (bucket, term, id) sorted by term, with the length of each list beside them.

    A term lies in one of `buckets` folders, so a look-up reads the folders of its terms and in them the row groups that may hold the term.
    """

    spark: SparkSession
    path: str
    buckets: int = 64

    def _bucket(self, term: Column | str) -> Column:
        return F.pmod(F.xxhash64(term), F.lit(self.buckets)).cast("int")

    def build(self, pairs: DataFrame, n_rows: int = 0) -> Lists:
        """Writes the lists of (term, id); repeated pairs are one. A long list is dealt over several files, whose number follows from the `n_rows` rows that the pairs come from.

        Pairs are moved before repeated ones are dropped: dropping them first would hold all pairs of a task, of which hardly any repeats.
        """
        deals = max(8, -(-n_rows // PER_FILE))
        rows = pairs.where("term is not null and id is not null").withColumn("bucket", self._bucket("term")).withColumn("deal", F.pmod(F.xxhash64("id"), F.lit(deals)))
        rows = (rows.repartition(self.buckets * deals, "bucket", "deal") if deals > 8 else rows.repartition("bucket", "deal")).dropDuplicates().drop("deal")
        rows.sortWithinPartitions("bucket", "term", "id").write.partitionBy("bucket").parquet(f"{self.path}/lists")
        counts = self.spark.read.parquet(f"{self.path}/lists").groupBy("bucket", "term").agg(F.count("*").alias("n"))
        counts.repartition("bucket").sortWithinPartitions("bucket", "term").write.partitionBy("bucket").parquet(f"{self.path}/lengths")
        return self

    def _of(self, table: str, terms: list[str]) -> DataFrame:
        numbers = self.spark.createDataFrame([(t,) for t in terms], "term string").select(self._bucket("term").alias("b")).distinct()
        found = sorted(r["b"] for r in numbers.collect())  # the terms asked for, a few
        return self.spark.read.parquet(f"{self.path}/{table}").where(F.col("bucket").isin(found) & F.col("term").isin(terms))

    def lengths(self, terms: list[str]) -> dict[str, int]:
        return {r["term"]: r["n"] for r in self._of("lengths", terms).collect()}

    def ids(self, term: str) -> DataFrame:
        return self._of("lists", [term]).select("id")

    def all_of(self, terms: list[str]) -> DataFrame:
        """Ids that are in the lists of all terms: the shortest list first, each next one by a semi join. A term without a list gives none."""
        terms = sorted(set(terms))
        if not terms:
            raise ValueError("no terms were given")
        n = self.lengths(terms)
        order = sorted(terms, key=lambda t: (n.get(t, 0), t))
        out = self.ids(order[0])
        for term in order[1:] if n.get(order[0]) else []:
            out = out.join(self.ids(term), "id", "left_semi")
        return out


def _spread(rows: DataFrame) -> tuple[DataFrame, int]:
    """(rows, their number): a small file can make very many terms, so its rows are dealt over tasks of about PER_TASK."""
    n = rows.count()
    tasks = -(-n // PER_TASK)
    return rows.repartition(tasks) if tasks > rows.sparkSession.sparkContext.defaultParallelism else rows, n


# --- JSON


def json_terms(value, path: str = "$") -> Iterator[str]:
    """What a value says, as terms: of each scalar its place and value, of each object and list its place and kind. Places in lists have no number."""
    if isinstance(value, dict):
        yield path + "{}"
        for k, v in value.items():
            yield from json_terms(v, f"{path}.{json.dumps(k)}")
    elif isinstance(value, list):
        yield path + "[]"
        for v in value:
            yield from json_terms(v, path + "[]")
    else:
        yield f"{path}={_scalar(value)}"


def _scalar(value) -> str:
    """Equal numbers are written alike, so 1 and 1.0 are the same; true is no number."""
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        return repr(int(value)) if value == int(value) else repr(float(value))
    return json.dumps(value)


def json_contains(whole, part) -> bool:
    """Whether every key, and every element in some element, of `part` is in `whole`, at all depths; equal scalars. A list at the top contains a scalar."""
    if isinstance(part, dict):
        return isinstance(whole, dict) and all(k in whole and json_contains(whole[k], v) for k, v in part.items())
    if isinstance(part, list):
        return isinstance(whole, list) and all(any(json_contains(w, v) for w in whole) for v in part)
    return not isinstance(whole, (dict, list)) and _scalar(whole) == _scalar(part)


def _parsed(text: str | None):
    """A value in a list of its own, or an empty list for what isn't JSON; NaN and infinities aren't."""
    try:
        return [] if text is None else [json.loads(text, parse_constant=lambda x: float(x) / 0)]
    except (ValueError, ZeroDivisionError, RecursionError):
        return []


def _term_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, terms = [], []
        for at, text in enumerate(batch.column("value").to_pylist()):
            for value in _parsed(text):
                own = set(json_terms(value))
                ids += [at] * len(own)
                terms += own
        yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(ids, pa.int64())), pa.array(terms, pa.string())], names=["id", "term"])


def json_index(df: DataFrame, id_column: str, column: str, path: str, buckets: int = 64) -> Lists:
    """Lists for containment in a column of JSON text; null and broken values are in no list."""
    rows, n = _spread(df.select(F.col(id_column).alias("id"), F.col(column).alias("value")))
    kind = rows.schema["id"].dataType.simpleString()
    return Lists(df.sparkSession, path, buckets).build(rows.mapInArrow(_term_rows, f"id {kind}, term string"), n)


def contains_json(part: str):
    """A column function: whether a JSON text contains the value `part`; null and broken texts don't."""
    wanted = json.loads(part)

    def run(values: pa.Array) -> pa.Array:
        return pa.array([any(json_contains(v, wanted) or (isinstance(v, list) and not isinstance(wanted, (dict, list)) and json_contains(v, [wanted])) for v in _parsed(x)) for x in values.to_pylist()])

    return F.arrow_udf(run, "boolean")


def search_json(df: DataFrame, id_column: str, column: str, index: Lists, part: str) -> DataFrame:
    """Rows of `df` whose JSON contains `part`: those that all lists of its terms have, looked at once more.

    A scalar at the top may also be an element of a list, so its rows are looked for both ways.
    """
    wanted = json.loads(part)
    ids = index.all_of(list(json_terms(wanted)))
    if not isinstance(wanted, (dict, list)):
        ids = ids.union(index.all_of(list(json_terms([wanted])))).distinct()
    return df.join(ids.withColumnRenamed("id", id_column), id_column, "left_semi").where(contains_json(part)(F.col(column)))


# --- substrings


def grams(c: Column) -> Column:
    """The distinct runs of three characters of a text in lower case."""
    low = F.lower(c)
    every = F.transform(F.sequence(F.lit(1), F.length(low) - (GRAM - 1)), lambda i: F.substr(low, i, F.lit(GRAM)))
    return F.when(F.length(low) >= GRAM, F.array_distinct(every)).otherwise(F.array().cast("array<string>"))


def substring_index(df: DataFrame, id_column: str, columns: list[str], path: str, buckets: int = 64) -> Lists:
    """Lists for substrings of some columns, whatever the case; one list a run of characters for all columns."""
    rows, n = _spread(df.select(F.col(id_column).alias("id"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(columns)]))
    own = F.array_distinct(F.flatten(F.array(*[F.coalesce(grams(F.col(f"c{i}")), F.array().cast("array<string>")) for i in range(len(columns))])))
    return Lists(df.sparkSession, path, buckets).build(rows.select("id", F.explode(own).alias("term")), n)


def has_substring(columns: list[str], needle: str) -> Column:
    """Whether one of the columns holds the needle, whatever the case; every character stands for itself."""
    out = F.lit(False)
    for c in columns:
        out = out | F.coalesce(F.contains(F.lower(c), F.lower(F.lit(needle))), F.lit(False))
    return out


def search_substring(df: DataFrame, id_column: str, columns: list[str], index: Lists, needle: str) -> DataFrame:
    """Rows of `df` with the needle in one of the columns. A needle of less than three characters has no list: all rows are looked at."""
    low = df.sparkSession.range(1).select(F.lower(F.lit(needle)).alias("x")).first()["x"]
    found = df.where(has_substring(columns, needle))
    if len(low) < GRAM:
        return found
    ids = index.all_of([low[i : i + GRAM] for i in range(len(low) - GRAM + 1)])
    return found.join(ids.withColumnRenamed("id", id_column), id_column, "left_semi")
