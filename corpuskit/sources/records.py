"""Record scans (A1-A5, A8, A9) and table extraction.

``read_records`` is a plain JSON scan into one VARIANT column (no schema
inference: fields that are a scalar in one record and a list in another stay
intact). ``extract_table`` keeps the reference order: cap -> repair -> filters ->
projection, where the repair is folded into the terminal of each repaired path.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuskit import fields as FD
from corpuskit.functions.paths import split_path, terminal
from corpuskit.functions.predicates import WHOLE, Filter, Record, conjunction, is_late
from corpuskit.functions.repair import repairs_from
from corpuskit.functions.variant import get_key, is_object


def read_records(spark: SparkSession, path: str | list[str], prefix: str | None = FD.DEFAULT_PREFIX,
                 sep: str = ".", repartition: int | None = None) -> DataFrame:
    """JSON lines -> ``v VARIANT`` re-rooted at ``prefix``.

    A malformed line fails the job (FAILFAST). A record without the prefix, or
    whose prefix is not an object, fails the job too. ``.gz`` input is read
    natively; as it cannot be split, pass ``repartition`` to spread the records.
    """
    df = (spark.read.option("singleVariantColumn", "v").option("mode", "FAILFAST")
          .json(path))
    if repartition:
        df = df.repartition(repartition)
    if prefix:
        return reroot(df, prefix, sep)
    return df


def reroot(df: DataFrame, prefix: str, sep: str = ".", col: str = "v") -> DataFrame:
    """Keep the sub-object at ``prefix``; raise when it is missing or not an object."""
    sub = F.col(col)
    for key in split_path(prefix, sep):
        sub = F.try_variant_get(sub, "$['" + key + "']", "variant")
    checked = F.when(sub.isNull() | ~is_object(sub),
                     F.raise_error(F.lit(f"prefix {prefix} missing or not an object in a record"))) \
        .otherwise(sub)
    return df.withColumn(col, checked)


def count_records(spark: SparkSession, path: str | list[str]) -> int:
    """Number of lines (A4); an action, so only for reporting."""
    return spark.read.text(path).count()


def records_count_frame(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """A4 as a lazy one-row DataFrame."""
    return spark.read.text(path).agg(F.count(F.lit(1)).alias("n"))


def cap(df: DataFrame, max_len: int | None, order: list[Column] | None = None) -> DataFrame:
    """A3: at most ``max_len`` records, counted before any filter.

    Which records survive is only defined for ordered input; pass ``order`` to
    make it deterministic.
    """
    if max_len is None:
        return df
    if order:
        df = df.orderBy(*order)
    return df.limit(int(max_len))


def extract_table(records: DataFrame, columns: Iterable[str] | Mapping[str, str],
                  filters: Iterable[Filter] = (), dropped_values: dict | None = None,
                  remapped_values: dict | None = None, max_len: int | None = None,
                  sep: str = ".", col: str = "v", keep: Iterable[str] = (),
                  order: list[Column] | None = None, flags: Mapping[str, Filter] | None = None) -> DataFrame:
    """A5: one terminal struct column per requested path (alias -> path).

    Every path used by a filter or a projection is compiled once into a hidden
    column; filters and the projection read those columns. Filters in Python (see
    ``predicates``) run behind the others, in an Arrow stage over the same columns.
    ``flags`` are filters whose results become Boolean columns, so that one walk serves
    several tables.
    """
    if isinstance(columns, Mapping):
        wanted = {alias: split_path(p, sep) for alias, p in columns.items()}
    else:
        wanted = {p: split_path(p, sep) for p in columns}
    repairs = repairs_from(dropped_values, remapped_values)
    filters, flags = list(filters), dict(flags or {})
    probe = Record(F.col(col), repairs, sep)
    for f in [*filters, *flags.values()]:
        f(probe)
    paths: list[tuple] = []
    for p in list(wanted.values()) + probe.used:
        if p not in paths:
            paths.append(p)
    hidden = {p: f"__t{i}" for i, p in enumerate(paths)}
    rec = Record(F.col(col), repairs, sep)
    df = cap(records, max_len, order)
    if probe.whole:
        hidden[WHOLE] = "__whole"
    # paths that begin alike share what the record has at their first key: it is copied once, not by each path
    tops = {k: f"__k{i}" for i, k in enumerate(dict.fromkeys(p[0] for p in paths if p))}
    top = F.struct(F.lit(True).alias("__"), *[get_key(F.col(col), k).alias(a) for k, a in tops.items()])

    def members(s) -> Column:
        walked = [terminal(F.col(col), p, repair=rec.repairs.get(p), first=s.getField(tops[p[0]]) if p else None).alias(hidden[p])
                  for p in paths]
        whole = [F.col(col).alias("__whole")] if probe.whole else []
        return F.struct(*[F.col(k) for k in keep], *walked, *whole)

    bundles = F.transform(F.array(top), members)

    def bound(s) -> Record:
        return Record(F.col(col), repairs, sep, bound={p: s.getField(h) for p, h in hidden.items()})

    early = [f for f in filters if not is_late(f)]
    late = [f for f in filters if is_late(f)]
    if filters or flags:
        # Each terminal is compiled once into the one bundle of ``bundles``; the filters read its fields
        # through a lambda variable. Filtering inside ``explode`` keeps the optimizer
        # from pushing a Filter below the projection and re-inlining every terminal.
        df = df.select(F.explode(F.filter(bundles, lambda s: conjunction(early)(bound(s)))).alias("__r"))
        if late:  # Python cannot run in the lambda: it judges what is left, on the same terminals
            df = df.where(conjunction(late)(bound(F.col("__r"))))
    else:
        df = df.select(F.get(bundles, 0).alias("__r"))
    return df.select(*[F.col("__r").getField(k).alias(k) for k in keep],
                     *[F.col("__r").getField(hidden[p]).alias(alias) for alias, p in wanted.items()],
                     *[f(bound(F.col("__r"))).alias(name) for name, f in flags.items()])


def read_vocabulary(spark: SparkSession, path: str | list[str], multiline: bool = True) -> DataFrame:
    """Vocabulary documents as ``v VARIANT`` (one JSON document per file,
    or one per line with ``multiline=False``)."""
    return (spark.read.option("multiLine", multiline).option("singleVariantColumn", "v")
            .option("mode", "FAILFAST").json(path))


def read_id_list(spark: SparkSession, path: str) -> DataFrame:
    """A10: an id list (first CSV column) -> ``doc_id STRING``; missing file -> empty."""
    from corpuskit.session import path_exists

    if not path_exists(spark, path):
        return spark.createDataFrame([], "doc_id string")
    return spark.read.csv(path).select(F.col("_c0").alias("doc_id")).distinct()


def write_id_list(ids: DataFrame, path: str) -> None:
    ids.select("doc_id").write.mode("overwrite").csv(path)
