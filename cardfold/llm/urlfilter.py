"""URL rules as a sort-merge range join.

A host's canonical key is its labels in reverse, each ended by a dot (``net.example.``),
so a rule's host with all its subdomains is one interval of keys. URLs and rules
are put in key order and each part is swept once, keeping a stack of the rules
whose interval is open: nested rules lie on top of each other, and a rule leaves
the stack with the first key it is no prefix of. A URL's rule is the longest one
on the stack whose path starts the URL's path.

URLs are cut into parts by range over (key, salt), so a host with a third of all
rows fills several parts. A rule is sent to every part that its interval meets.

Defined results. Null URL or one without ``://``: empty host and path, no rule,
verdict ``allow``. Empty labels are kept as they are. Of equally long rules the
later in text order wins; of repeated rules a block wins. Extra columns pass
through.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cardfold.llm.common import free_name, store

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: Column) -> Column:
    """What follows the first ``://``; null without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    host = F.regexp_extract(_rest(url), r"\A[^/?#]*", 0)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"\A[^/?#]*([^?#]*)", 1), F.lit(""))


def key_of(host: Column) -> Column:
    """Labels in reverse, a dot after each."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def _sweep(names: list[str], found_col: str):
    """Rows come in order of (part, key, rules first)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, stack = None, []  # of (key, [(rule length, rule, path, verdict)])
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("_part", "_key", "_rule", "_path", "_verdict"))
            keep, found, verdicts = [], [], []
            for i, (p, key, rule, path, verdict) in enumerate(zip(*columns)):
                if p != part:
                    part, stack = p, []
                while stack and not key.startswith(stack[-1][0]):
                    stack.pop()
                if rule is not None:
                    if not stack or stack[-1][0] != key:
                        stack.append((key, []))
                    stack[-1][1].append((len(rule), rule, verdict == "block", path, verdict))
                    continue
                fits = [r for _, own in stack for r in own if path.startswith(r[3])]
                best = max(fits) if fits else None
                keep.append(i)
                found.append(best and best[1])
                verdicts.append(best[4] if best else None)
            rows = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*(rows.column(c) for c in names), pa.array(found, pa.string()), pa.array(verdicts, pa.string())],
                [*names, f"{found_col}_rule", f"{found_col}_verdict"],
            )

    return run


def match(
    pages: DataFrame, rules: DataFrame, url_col: str = "url", found_col: str = "url", default: str = "allow"
) -> DataFrame:
    """``pages`` with ``<found_col>_host``, ``_path``, ``_rule`` and ``_verdict``.

    ``rules``: verdict, host, path.
    """
    spark = pages.sparkSession
    host, path = f"{found_col}_host", f"{found_col}_path"
    rows = pages.withColumns({host: host_of(F.col(url_col)), path: path_of(F.col(url_col))})
    rows = rows.withColumns({"_key": key_of(F.col(host)), "_salt": F.xxhash64(host, path, url_col)})
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartitionByRange(parts, "_key", "_salt").withColumn("_part", F.spark_partition_id())
    rows = store(rows.drop("_salt"), "urls")
    bounds = rows.groupBy("_part").agg(F.min("_key").alias("_low"), F.max("_key").alias("_high"))

    own = rules.select(
        key_of(F.translate("host", UPPER, LOWER)).alias("_key"),
        F.concat("host", "path").alias("_rule"),
        F.col("path").alias("_path"),
        F.col("verdict").alias("_verdict"),
    ).distinct()
    # A rule's interval [key, key + everything) meets a part unless it lies wholly beside it.
    meets = (F.col("_key") <= F.col("_high")) & (
        (F.col("_key") >= F.col("_low")) | F.startswith(F.col("_low"), F.col("_key"))
    )
    # One row a part; its number is the session's number of shuffle partitions.
    own = own.join(F.broadcast(bounds.select("_part", "_low", "_high")), meets).drop("_low", "_high")

    names = [c for c in rows.columns if c not in ("_part", "_key")]
    data = rows.withColumns({"_rule": F.lit(None).cast("string"), "_path": F.col(path), "_verdict": F.lit(None).cast("string")})
    both = data.unionByName(own, allowMissingColumns=True).withColumn("_kind", F.col("_rule").isNull().cast("int"))
    both = both.repartition(parts, "_part").sortWithinPartitions("_part", "_key", "_kind")
    fields = ", ".join(f"`{n}` {rows.schema[n].dataType.simpleString()}" for n in names)
    schema = f"{fields}, `{found_col}_rule` string, `{found_col}_verdict` string"
    swept = both.mapInArrow(_sweep(names, found_col), schema)
    return swept.withColumn(f"{found_col}_verdict", F.coalesce(f"{found_col}_verdict", F.lit(default)))
