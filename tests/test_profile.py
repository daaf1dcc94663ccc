import datetime as dt
import itertools

from pyspark.sql import functions as F

from brightledger.operators import profile

SCHEMA = "id string, load_id int, loaded_at timestamp_ntz, contract_amount double, award_date timestamp_ntz, reference_id string, extra string"
DAY = dt.datetime(2024, 5, 1, 7)


def rows(loads=6, n=80):
    out = []
    for k in range(loads):
        for i in range(n):
            day = DAY + dt.timedelta(days=30 * k)
            out.append([f"{k}-{i}", k, day, 1000.0 * (1 + (i * 37) % 500), day - dt.timedelta(days=(i * 7) % 60), f"{10000000 + k * 1000 + i}", None])
    return out


def write(spark, tmp_path, data, name="t"):
    path = str(tmp_path / name)
    spark.createDataFrame([tuple(r) for r in data], SCHEMA).coalesce(2).write.parquet(path)
    return spark.read.parquet(path)


def issues(df):
    return {(r.column_name, r.issue, r.item) for r in profile.find_issues(df).collect()}


def test_clean_table_has_none(spark, tmp_path):
    assert issues(write(spark, tmp_path, rows())) == set()


def test_violations(spark, tmp_path):
    d = rows()
    d[0][3], d[1][3], d[2][3], d[3][3], d[4][3] = float("nan"), 0.99, 1e10 + 1, 1.0, 1e10
    d[5][4], d[6][4], d[7][4] = dt.datetime(2005, 12, 31, 23), d[6][2] + dt.timedelta(days=1), d[7][2].replace(hour=23)
    d[8][5], d[9][5], d[10][5] = "1000-1", "", None
    d[11][3] = d[12][4] = None
    want = {("contract_amount", "violation", f"0-{i}") for i in (0, 1, 2)} | {("award_date", "violation", f"0-{i}") for i in (5, 6)} | {("reference_id", "violation", "0-8")}
    assert issues(write(spark, tmp_path, d)) == want


def test_early_years_are_violations(spark, tmp_path):
    # Texts of years under 1000 do not compare as days do; a footer must not clear such a file.
    d = rows()
    d[0][4], d[1][4], d[2][4] = dt.datetime(206, 1, 5), dt.datetime(999, 12, 31, 23, 59), dt.datetime(1, 1, 1)
    df = write(spark, tmp_path, d)
    assert {x for x in issues(df) if x[1] == "violation"} == {("award_date", "violation", f"0-{i}") for i in (0, 1, 2)}
    got = profile.profile_columns(df, ["award_date"]).first()
    assert (got.least, got.greatest[:4]) == ("0001-01-01", "2024")


def test_only_chunks_that_are_not_cleared_are_read(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    d = rows(4, 200)
    d[5][3], d[250][4], d[460][5] = float("nan"), dt.datetime(1999, 1, 1), "x"
    cols = ["id", "load_id", "loaded_at", "contract_amount", "award_date", "reference_id", "extra"]
    kinds = [pa.string(), pa.int32(), pa.timestamp("us"), pa.float64(), pa.timestamp("us"), pa.string(), pa.string()]
    for coded in (True, False):
        path = str(tmp_path / f"groups{coded}.parquet")
        pq.write_table(pa.table([pa.array([r[i] for r in d], k) for i, k in enumerate(kinds)], names=cols), path, row_group_size=100, use_dictionary=coded, compression="gzip")
        seen = []
        real = profile.read_chunks

        def watched(which, *rest, seen=seen, real=real):
            seen.extend((r.chunk, r.test) for r in which.collect())
            return real(which, *rest)

        profile.read_chunks = watched
        try:
            got = issues(spark.read.parquet(path))
        finally:
            profile.read_chunks = real
        assert {x for x in got if x[1] == "violation"} == {("contract_amount", "violation", "0-5"), ("award_date", "violation", "1-50"), ("reference_id", "violation", "2-60")}
        amounts = [0] if coded else range(8)  # no footer rules out NaN; a dictionary does
        assert sorted(seen) == sorted([(g, "contract_amount") for g in amounts] + [(2, "award_date"), (4, "reference_id")])


def test_columns_without_statistics_are_filtered(spark, tmp_path):
    d = rows()
    d[0][4], d[1][4] = dt.datetime(206, 1, 5), None
    path = str(tmp_path / "text")
    write(spark, tmp_path, d).withColumn("award_date", F.col("award_date").cast("string")).write.parquet(path)
    assert {x for x in issues(spark.read.parquet(path)) if x[1] == "violation"} == {("award_date", "violation", "0-0")}


def test_drift(spark, tmp_path):
    d = rows()
    for r in d:
        if r[1] == 1:
            r[3] = r[3] / 1000 + 2
        if r[1] == 2 and int(r[0][2:]) % 2:
            r[4] = None
        if r[1] == 3 and int(r[0][2:]) % 2:
            r[4] = dt.datetime(2020, 1, 1)
        if r[1] == 4 and int(r[0][2:]) % 2:
            r[5] = "00000000"
    assert {x for x in issues(write(spark, tmp_path, d)) if x[1] == "drift"} == {("contract_amount", "drift", "1"), ("award_date", "drift", "2"), ("award_date", "drift", "3"), ("reference_id", "drift", "4")}


def drifts(df):
    return {x for x in issues(df) if x[1] == "drift"}


def test_drift_of_rows_piled_on_a_few_values(spark, tmp_path):
    # No value alone holds much: four codes, four amounts and four days share half a load's rows.
    d = rows(8, 200)
    for r in d:
        i = int(r[0].split("-")[1])
        if i % 2:
            if r[1] == 1:
                r[5] = f"9000000{i // 2 % 4}"
            if r[1] == 2:
                r[3] = 1000.0 * (101 + 100 * (i // 2 % 4))
            if r[1] == 3:
                r[4] = r[2] - dt.timedelta(days=9 + 14 * (i // 2 % 4))
    assert drifts(write(spark, tmp_path, d)) == {("reference_id", "drift", "1"), ("contract_amount", "drift", "2"), ("award_date", "drift", "3")}


def test_drift_of_forms(spark, tmp_path):
    d = rows(8, 200)
    for r in d:
        if r[1] == 5 and int(r[0].split("-")[1]) % 3 == 0:
            r[5] = "A-" + r[5]
    assert drifts(write(spark, tmp_path, d)) == {("reference_id", "drift", "5")}


def test_small_load_is_no_drift(spark, tmp_path):
    # A value repeats less in fewer rows; that is no departure.
    d = [r for r in rows(8, 400) if r[1] != 4 or int(r[0].split("-")[1]) < 70]
    for r in d:
        r[5] = f"{10000000 + int(r[0].split('-')[1]) % 100}"
    assert drifts(write(spark, tmp_path, d)) == set()


def test_expected_distinct_against_brute_force():
    rows_ = [0, 0, 0, 1, 1, 2, 3]
    for m in (1, 2, 3, 7):
        drawn = list(itertools.combinations(rows_, m))
        assert abs(profile.expected_distinct([(3, 1), (2, 1), (1, 2)], m) - sum(len(set(x)) for x in drawn) / len(drawn) / m) < 1e-9
    assert profile.expected_distinct([(3, 1)], 4) is None


def test_empty_and_null(spark, tmp_path):
    assert issues(write(spark, tmp_path, [])) == set()
    assert issues(write(spark, tmp_path, [["a", None, None, None, None, None, None]], "n")) == set()


def test_footers(spark, tmp_path):
    df = write(spark, tmp_path, rows())
    got = profile.chunks(df, ["contract_amount", "reference_id"]).collect()
    assert sum(r.rows for r in got if r.column_name == "reference_id") == df.count()
    assert all(r.nulls == 0 for r in got) and min(float(r.least) for r in got if r.column_name == "contract_amount") == 1000.0
    values = {r.value for r in profile.distinct_values(df, ["reference_id"]).collect()}
    assert values == {r.reference_id for r in df.select("reference_id").collect()}


def test_profile(spark, tmp_path):
    d = rows(2, 10)
    d[0][3], d[1][3], d[2][5], d[3][5] = float("nan"), None, " ", None
    got = {r.column_name: r for r in profile.profile_columns(write(spark, tmp_path, d), ["contract_amount", "reference_id", "award_date", "extra"]).collect()}
    assert (got["contract_amount"].rows, got["contract_amount"].missing, got["contract_amount"].greatest) == (20, 1, "NaN")
    assert (got["reference_id"].missing, got["reference_id"].distinct_values) == (2, 18)
    assert (got["extra"].missing, got["extra"].distinct_values, got["extra"].least) == (20, 0, None)
    empty = {r.column_name: r for r in profile.profile_columns(write(spark, tmp_path, [], "e"), ["reference_id"]).collect()}
    assert (empty["reference_id"].rows, empty["reference_id"].missing, empty["reference_id"].least) == (0, 0, None)
