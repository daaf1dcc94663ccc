"""Column-level data quality: missing, distinct, extreme, ill-formed and (between loads) shifted values of large Parquet tables.

Footers come first: exact null counts and extrema of each column chunk. Dictionary pages of dictionary-coded chunks give the
distinct candidates and their forms without the pages of values. Only chunks whose footers and dictionaries cannot rule out a finding are read.
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightledger.session import written
from brightledger.sources.columnar import ColumnFile

_EPOCH = dt.date(1970, 1, 1)


def _paths(df: DataFrame) -> DataFrame:
    files = sorted(df.inputFiles())
    spark = df.sparkSession
    return spark.createDataFrame([(f,) for f in files], "path string").repartition(max(1, min(len(files), 4 * spark.sparkContext.defaultParallelism)))


def _rows(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


def chunks(df: DataFrame, columns: list[str]) -> DataFrame:
    """(path, chunk, column_name, rows, nulls, least, greatest, least_day, greatest_day, dictionary) of each chunk of ``columns`` in the files of ``df``, from footers alone.

    ``nulls`` is null where the footer has none; ``least`` and ``greatest`` (as text) are null where they are missing or may be cut; those of dates and
    timestamps also come as days since 1970, which is what is compared, as texts of early years do not compare. ``dictionary`` says whether all pages of
    values are coded by a dictionary. Floating extrema say nothing about NaN. ``df`` must be a plain read of Parquet files.
    """
    names = ["path", "chunk", "column_name", "rows", "nulls", "least", "greatest", "least_day", "greatest_day", "dictionary"]
    kinds = [pa.string(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.bool_()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                f = ColumnFile(path)
                out = [(path, g, c, *f.statistics(g, c), f.coded(g, c)) for g in range(f.meta.num_row_groups) for c in columns if c in f.at]
                yield _rows(pa.schema(list(zip(names, kinds))), out)

    return _paths(df).mapInArrow(run, "path string, chunk int, column_name string, rows long, nulls long, least string, greatest string, least_day long, greatest_day long, dictionary boolean")


def read_chunks(which: DataFrame, columns: list[str], look: Callable[[str, pa.Table], pa.RecordBatch], schema: str) -> DataFrame:
    """What ``look`` (of a name and the chunk's table) makes of each chunk in ``which`` (path, chunk, test); ``columns``: names by test."""
    spark = which.sparkSession
    n = which.count()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, f = None, None
        for batch in batches:
            for p, g, test in zip(*(c.to_pylist() for c in batch.columns)):
                if p != path:
                    path, f = p, ColumnFile(p)
                yield look(test, f.chunk(g, columns[test]))

    return which.select("path", "chunk", "test").repartition(max(1, min(n, 8 * spark.sparkContext.defaultParallelism))).mapInArrow(run, schema)


def distinct_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """(path, chunk, column_name, value, number) of the distinct non-null values of ``columns`` in each chunk, as text (numbers also as such).

    They come from the dictionary page alone where all pages of values are coded by it; other chunks are read.
    """
    names = ["path", "chunk", "column_name", "value", "number"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                f = ColumnFile(path)
                for g in range(f.meta.num_row_groups):
                    for c in columns:
                        v = f.distinct(g, c)
                        number = v.cast(pa.float64(), safe=False) if pa.types.is_integer(v.type) or pa.types.is_floating(v.type) else pa.nulls(len(v), pa.float64())
                        if pa.types.is_floating(v.type):
                            v = pc.add(v, 0.0)  # one zero
                        n = len(v)
                        yield pa.RecordBatch.from_arrays([pa.repeat(path, n), pa.repeat(pa.scalar(g, pa.int32()), n), pa.repeat(c, n), v.cast(pa.string()), number], names=names)

    return _paths(df).mapInArrow(run, "path string, chunk int, column_name string, value string, number double")


def shape(c: Column) -> Column:
    """Form of a text: each digit as 9, each letter as A, other characters as they are."""
    return F.regexp_replace(F.regexp_replace(c, r"\p{Nd}", "9"), r"\p{L}", "A")


def _shape(v: pa.Array) -> pa.Array:
    return pc.replace_substring_regex(pc.replace_substring_regex(v, r"\p{Nd}", "9"), r"\p{L}", "A")


def _full(v: pa.Array) -> pa.Array:
    """Whether a text has more than blanks; false for null."""
    return pc.fill_null(pc.not_equal(pc.utf8_trim(v, " "), ""), False)


def profile_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, rows, missing, distinct_values, least, greatest) of ``columns`` of a plain Parquet read; extrema as text, of timestamps as days.

    Nulls and blank texts are missing and not counted as values. Row and null counts come from footers, values from dictionary pages (chunks that
    left the dictionary are read). Chunks whose values hold a blank or whose footers lack the null count are read for missing ones. Extrema of dates come from
    footers, if all have them; those of floating numbers from the values, as footers leave out NaN (a value, and the greatest). An empty table gives
    0 rows and null extrema.
    """
    types = dict(df.dtypes)
    foot = written(chunks(df, columns), "footers")
    values = written(distinct_values(df, columns), "values")
    text = F.col("column_name").isin(*[c for c in columns if types[c] == "string"]) if any(types[c] == "string" for c in columns) else F.lit(False)
    blank = text & (F.length(F.trim("value")) == 0)
    seen = values.filter(~blank).groupBy("column_name").agg(
        F.countDistinct("value").alias("distinct_values"), F.min("value").alias("a"), F.max("value").alias("z"), F.min("number").alias("least_number"), F.max("number").alias("greatest_number"))
    odd = values.filter(blank).select("path", "chunk", "column_name").distinct().withColumn("odd", F.lit(True))
    foot = written(foot.join(odd, ["path", "chunk", "column_name"], "left").withColumn("odd", F.coalesce("odd", F.lit(False)) | F.col("nulls").isNull()), "footers")

    def missing(test: str, t: pa.Table) -> pa.RecordBatch:
        v = t.column(0).combine_chunks()
        n = len(v) - pc.sum(_full(v)).as_py() if pa.types.is_string(v.type) or pa.types.is_large_string(v.type) else v.null_count
        return pa.RecordBatch.from_arrays([pa.array([test]), pa.array([n], pa.int64())], names=["column_name", "n"])

    again = foot.filter("odd").select("path", "chunk", F.col("column_name").alias("test"))
    more = read_chunks(again, {c: [c] for c in columns}, missing, "column_name string, n long").groupBy("column_name").agg(F.sum("n").alias("more"))
    total = foot.groupBy("column_name").agg(
        F.sum("rows").alias("rows"), F.sum(F.when(~F.col("odd"), F.col("nulls"))).alias("nulls"), F.min("least_day").alias("d0"), F.max("greatest_day").alias("d1"),
        F.count_if(F.col("least_day").isNull() & (F.col("rows") > F.coalesce("nulls", F.lit(0)))).alias("cut"))
    named = df.sparkSession.createDataFrame([(c, i, types[c]) for i, c in enumerate(columns)], "column_name string, at int, type string")
    out = named.join(total, "column_name", "left").join(seen, "column_name", "left").join(more, "column_name", "left")
    dated = F.col("type").isin("date", "timestamp", "timestamp_ntz")
    day = lambda d, v: F.when(F.col("cut") == 0, F.date_format(F.date_add(F.lit(_EPOCH), F.col(d).cast("int")), "yyyy-MM-dd")).otherwise(F.substring_index(v, " ", 1))
    shown = lambda d, v, n: F.when(dated, day(d, v)).when(F.col(n).isNotNull(), F.when(F.col("type").isin("double", "float"), F.col(n).cast("string")).otherwise(F.col(n).cast("decimal(20,0)").cast("string"))).otherwise(F.col(v))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint")
    return out.select(
        "column_name", zero("rows").alias("rows"), (zero("nulls") + zero("more")).alias("missing"), zero("distinct_values").alias("distinct_values"),
        shown("d0", "a", "least_number").alias("least"), shown("d1", "z", "greatest_number").alias("greatest"),
    )


#: Sizes of the random samples whose expected distinct values are compared between loads.
SAMPLES = (16, 64, 256, 1024)


def expected_distinct(counts: list[tuple[int, int]], m: int) -> float | None:
    """Expected share of distinct values among ``m`` rows drawn without return; ``counts`` has (rows of a value, number of such values). None for fewer rows than ``m``.

    Unlike the share of distinct values of all rows it does not depend on how many rows there are.
    """
    n = sum(c * f for c, f in counts)
    if n < m:
        return None
    whole = math.lgamma(n + 1) - math.lgamma(n - m + 1)
    missed = lambda c: math.exp(math.lgamma(n - c + 1) - math.lgamma(n - c - m + 1) - whole) if n - c >= m else 0.0
    return sum(f * (1 - missed(c)) for c, f in counts) / m


def _spread_of(values: DataFrame) -> DataFrame:
    """(load, k, top, distinct) of the rows (load, k, v): rows of the most frequent v, and the expected distinct shares for ``SAMPLES``. Counts are exact (of 64-bit hashes)."""
    counts = values.groupBy("load", "k", "v").agg(F.count(F.lit(1)).alias("c")).groupBy("load", "k", "c").agg(F.count(F.lit(1)).alias("f"))
    # As many pairs at most as different counts add up to the load's rows: about the root of twice those.
    grouped = counts.groupBy("load", "k").agg(F.collect_list(F.struct("c", "f")).alias("counts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spectra = [[(x["c"], x["f"]) for x in r] for r in batch.column(2).to_pylist()]
            top = pa.array([max(c for c, _ in r) for r in spectra], pa.int64())
            distinct = pa.array([[expected_distinct(r, m) for m in SAMPLES] for r in spectra], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), top, distinct], names=["load", "k", "top", "distinct"])

    return grouped.mapInArrow(run, "load string, k string, top long, distinct array<double>")


def load_statistics(df: DataFrame, load: str, day: str, amount: str, date: str, code: str, form: str | None = None) -> DataFrame:
    """Per load: rows, missing shares, and of an amount (a), a date (d) and a code (c) the rows of the most frequent value and the expected distinct shares of ``SAMPLES``.

    Quartiles are of the amount's logarithm and of the date as days before the load's day; a code has none, but the rows of its most frequent form, and those of the
    given ``form`` (c_good).
    """
    a, d, c = F.col(amount), F.to_date(date), F.col(code)
    lag = F.datediff(F.to_date(day), d)
    log = F.when(~F.isnan(a) & (a > 0), F.log(a))
    blank = c.isNull() | (F.length(F.trim(c)) == 0)
    kept = df.select(F.col(load).cast("string").alias("load"), a.alias("a"), log.alias("log"), d.alias("d"), lag.alias("lag"), F.when(~blank, c).alias("c"))
    quart = lambda x: F.percentile_approx(x, [0.25, 0.5, 0.75], 2000)
    base = kept.groupBy("load").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("a").isNull()).alias("a_missing"), F.count_if(F.col("d").isNull()).alias("d_missing"), F.count_if(F.col("c").isNull()).alias("c_missing"),
        F.count_if(F.coalesce(shape(F.col("c")) == F.lit(form), F.lit(False))).alias("c_good"),
        quart("log").alias("a_q"), quart(F.log1p(F.greatest(F.col("lag"), F.lit(0)).cast("double"))).alias("d_q"),
    )
    seen = lambda k, v, x: F.struct(F.lit(k).alias("k"), F.when(x.isNotNull(), F.xxhash64(v)).alias("v"))
    c = F.col("c")
    values = kept.select("load", F.inline(F.array(seen("a", F.col("a"), F.col("a")), seen("d", F.col("d"), F.col("d")), seen("c", c, c), seen("form", shape(c), c)))).filter(F.col("v").isNotNull())
    part = lambda k, x: F.max(F.when(F.col("k") == k, F.col(x)))
    spread = _spread_of(values).groupBy(F.col("load").alias("of")).agg(
        *[part(k, "top").alias(f"{k}_top") for k in "adc"], part("form", "top").alias("c_form"), *[part(k, "distinct").alias(f"{k}_distinct") for k in "adc"],
    )
    return base.join(spread, F.col("load").eqNullSafe(F.col("of")), "left").drop("of")


def drifted(stats: list[dict], key: str, shift: float) -> list[str]:
    """Loads whose missing share or spread in column ``key`` (prefix of the statistics) departs from most loads'.

    A missing share departs by 0.1 and by 6 median deviations and 5 standard errors; the share of the most frequent value or form by 0.15
    likewise; the expected distinct share of a sample by 0.15 of most loads' likewise (rows that pile up on a few values lower it, rows
    more widely spread raise it); a quartile (where there are some) by ``shift`` and 8 median deviations.
    """
    def median(x: list[float]) -> float:
        y = sorted(x)
        return 0.0 if not y else (y[len(y) // 2] + y[(len(y) - 1) // 2]) / 2

    out: set[str] = set()

    def flag(values: dict[str, float], least: float, times: float, noise: dict[str, float]) -> None:
        if len(values) < 3:
            return
        mid = median(list(values.values()))
        mad = median([abs(v - mid) for v in values.values()])
        out.update(k for k, v in values.items() if abs(v - mid) > max(least, times * mad, noise.get(k, 0.0)))

    size = {s["load"]: max(1, s["n"]) for s in stats}
    miss = {s["load"]: s[f"{key}_missing"] / size[s["load"]] for s in stats}
    base = median(list(miss.values()))
    flag(miss, 0.1, 6, {k: 5 * (max(base, 0.01) * (1 - base) / n) ** 0.5 for k, n in size.items()})
    full = {s["load"]: size[s["load"]] - s[f"{key}_missing"] for s in stats}
    for share in ("top", "form"):
        top = {s["load"]: (s[f"{key}_{share}"] or 0) / full[s["load"]] for s in stats if full[s["load"]] > 0 and f"{key}_{share}" in s}
        usual = median(list(top.values()))
        flag(top, 0.15, 6, {k: 5 * (max(usual, 0.02) * max(1 - usual, 0.02) / max(1, full[k])) ** 0.5 for k in top})
    for i in range(len(SAMPLES)):
        distinct = {s["load"]: s[f"{key}_distinct"][i] for s in stats if s.get(f"{key}_distinct") and s[f"{key}_distinct"][i] is not None}
        usual = median(list(distinct.values()))
        flag(distinct, 0.15 * usual, 6, {k: 5 * (max(usual, 0.02) * max(1 - usual, 0.02) / max(1, full[k])) ** 0.5 for k in distinct})
    for i in range(3):
        q = {s["load"]: s[f"{key}_q"][i] for s in stats if s.get(f"{key}_q")}
        flag(q, shift, 8, {k: 8 / max(1, full[k]) ** 0.5 for k in q})
    return sorted(out)


def _days(v: pa.ChunkedArray) -> np.ndarray:
    """Days since 1970 of dates or timestamps, whatever the year; 0 for null."""
    if pa.types.is_date32(v.type):
        return v.cast(pa.int32()).fill_null(0).to_numpy().astype(np.int64)
    return np.floor_divide(v.cast(pa.timestamp("us"), safe=False).cast(pa.int64()).fill_null(0).to_numpy(), 86_400_000_000)


def find_issues(
    df: DataFrame, key: str = "id", load: str = "load_id", day: str = "loaded_at", amount: str = "contract_amount", date: str = "award_date", code: str = "reference_id",
    least: float = 1.0, most: float = 1e10, first_day: str = "2006-01-01", usual_share: float = 0.9,
) -> DataFrame:
    """(column_name, issue, item): ill-formed or impossible values (issue ``violation``, item the row's key) and loads that depart (``drift``, item the load).

    A violation is an amount that is NaN, below ``least`` or above ``most``; a date before ``first_day`` or after the row's load day; a
    present code not of the form that ``usual_share`` of the present ones have (if one form does). Missing values are none. Rows with a null key report a null item. ``df`` is a plain
    Parquet read; an empty table has no issues. Other columns are not read.

    Only chunks are read for violations that neither footers (days) nor dictionary pages (amounts, with NaN, and forms of codes) clear. Columns of a kind that
    the files' statistics do not serve (dates kept as text, instants with a zone) are filtered by Spark instead. Statistics per load (a few numbers each) come to
    the driver; the number of loads is that of deliveries, not of rows.
    """
    spark = df.sparkSession
    types = dict(df.dtypes)
    first = (dt.date.fromisoformat(first_day) - _EPOCH).days
    foot = written(chunks(df, [amount, date, day, code]), "footers")

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Forms of the code in each chunk, and whether a coded chunk of amounts holds a bad one."""
        schema = pa.schema([("path", pa.string()), ("chunk", pa.int32()), ("column_name", pa.string()), ("form", pa.string()), ("n", pa.int64())])
        for batch in batches:
            for path in batch.column(0).to_pylist():
                f = ColumnFile(path)
                for g in range(f.meta.num_row_groups):
                    v = f.distinct(g, code).cast(pa.string())
                    forms = _shape(v.filter(_full(v))).value_counts().to_pylist()
                    out = [(path, g, code, x["values"], x["counts"]) for x in forms]
                    v = f.dictionary(g, amount)
                    if v is not None and pa.types.is_floating(v.type):
                        x = v.to_numpy(zero_copy_only=False)
                        out.append((path, g, amount, "bad" if (np.isnan(x) | (x < least) | (x > most)).any() else "good", len(x)))
                    yield _rows(schema, out)

    plain = types[key] in ("string", "int", "bigint")
    by_chunk = {amount: plain and types[amount] in ("double", "float"), date: plain and {types[date], types[day]} <= {"date", "timestamp_ntz"}, code: plain and types[code] == "string"}
    seen = written(_paths(df).mapInArrow(marks, "path string, chunk int, column_name string, form string, n long"), "forms") if types[code] == "string" else spark.createDataFrame([], "path string, chunk int, column_name string, form string, n long")
    # The usual form is sought among the distinct candidates first; the rows decide.
    likely = seen.filter(F.col("column_name") == code).groupBy("form").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "form").limit(1).collect()
    stats = [r.asDict(recursive=True) for r in load_statistics(df, load, day, amount, date, code, likely[0].form if likely else None).collect()]
    n, good = (sum(s["n"] - s["c_missing"] for s in stats), sum(s["c_good"] for s in stats))
    usual = None
    if n and likely and good >= usual_share * n:
        usual = likely[0].form
    elif n:
        best = df.filter(F.length(F.trim(code)) > 0).groupBy(shape(F.col(code)).alias("form")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "form").limit(1).first()
        usual = best.form if best.n >= usual_share * n else None
    # Chunks that footers and dictionaries do not clear.
    at = ["path", "chunk"]
    whole = F.coalesce(F.col("rows") == F.col("nulls"), F.lit(False))
    of = lambda c: foot.filter((F.col("column_name") == c) & ~whole)
    cleared = seen.filter((F.col("column_name") == amount) & (F.col("form") == "good"))
    loaded = foot.filter(F.col("column_name") == day).select(*at, F.col("least_day").alias("loaded"))
    late = of(date).join(loaded, at, "left").filter(~F.coalesce((F.col("least_day") >= first) & (F.col("greatest_day") <= F.col("loaded")), F.lit(False)))
    odd = of(code).join(seen.filter((F.col("column_name") == code) & (F.col("form") != F.lit(usual))).select(*at).distinct(), at) if usual is not None else None
    tests = {amount: of(amount).join(cleared, at, "left_anti"), date: late, code: odd}

    def look(test: str, t: pa.Table) -> pa.RecordBatch:
        v = t.column(test)
        full = v.is_valid().to_numpy()
        if test == amount:
            x = v.fill_null(0.0).to_numpy()
            bad = full & (np.isnan(x) | (x < least) | (x > most))
        elif test == date:
            x = _days(v)
            bad = full & ((x < first) | (t.column(day).is_valid().to_numpy() & (x > _days(t.column(day)))))
        else:
            v = v.combine_chunks()
            bad = pc.and_(_full(v), pc.fill_null(pc.not_equal(_shape(v), usual), False)).to_numpy(zero_copy_only=False)
        item = t.column(key).combine_chunks().cast(pa.string()).filter(pa.array(bad))
        return pa.RecordBatch.from_arrays([pa.repeat(test, len(item)), pa.repeat("violation", len(item)), item], names=["column_name", "issue", "item"])

    schema = "column_name string, issue string, item string"
    result = spark.createDataFrame([(c, "drift", x) for c, k, shift in ((amount, "a", 1.0), (date, "d", 1.0), (code, "c", 1e9)) for x in drifted(stats, k, shift) if x is not None], schema)
    wanted = [which.select(*at, F.lit(c).alias("test")) for c, which in tests.items() if by_chunk[c] and which is not None]
    if wanted:
        every = wanted[0]
        for w in wanted[1:]:
            every = every.unionByName(w)
        result = result.unionByName(read_chunks(written(every, "chunks"), {amount: [key, amount], date: [key, date, day], code: [key, code]}, look, schema))
    a, d = F.col(amount), F.to_date(date)
    filters = {amount: F.isnan(a) | (a < least) | (a > most), date: (d < F.to_date(F.lit(first_day))) | (d > F.to_date(day)), code: (F.length(F.trim(code)) > 0) & (shape(F.col(code)) != F.lit(usual)) if usual is not None else None}
    for c, bad in filters.items():
        if not by_chunk[c] and bad is not None:
            result = result.unionByName(df.filter(bad).select(F.lit(c).alias("column_name"), F.lit("violation").alias("issue"), F.col(key).cast("string").alias("item")))
    return result
