"""Versioned tables, quarantine of broken lines, monthly counts, stored models."""

import datetime
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail import schema as S
from contrail.functions.calendar import iso_week, iso_year
from contrail.operators import features as FT
from contrail.operators import incremental as INC
from contrail.operators import model_store as MS
from contrail.operators import models as M
from contrail.sources import files as FS
from contrail.sources import versions as V


def ids(df):
    return sorted(r[0] for r in df.collect())


def test_versions_replace_and_read_back(spark, tmp_path):
    path = str(tmp_path / "t")
    assert V.current_version(spark, path) == 0
    with pytest.raises(FileNotFoundError):
        V.read_version(spark, path)
    assert V.write_version(spark.range(3), path) == 1
    assert V.replace(spark, path, lambda df: df.where("id > 0")) == 2
    assert ids(V.read_version(spark, path)) == [1, 2] and ids(V.read_version(spark, path, 1)) == [0, 1, 2]
    assert V.write_version(spark.range(5).withColumn("p", F.col("id") % 2), path, partition_by=["p"]) == 3
    assert V.drop_old_versions(spark, path, keep=1) == [1, 2] and V.versions(spark, path) == [3]
    assert ids(V.read_version(spark, path)) == list(range(5))


def test_a_writer_that_stops_anywhere_leaves_a_whole_version(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    V.write_version(spark.range(3), path)

    def stop(*_):
        raise KeyboardInterrupt
    with monkeypatch.context() as m:  # data written, not committed
        m.setattr(V, "_commit", stop)
        with pytest.raises(KeyboardInterrupt):
            V.write_version(spark.range(9), path)
    assert ids(V.read_version(spark, path)) == [0, 1, 2]
    # commit file begun, not completed
    (tmp_path / "t" / V.COMMITS / V._commit_name(2)).write_text("data-0000")
    assert V.current_version(spark, path) == 1 and ids(V.read_version(spark, path)) == [0, 1, 2]
    assert V.write_version(spark.range(4), path) == 3
    assert V.versions(spark, path) == [1, 3] and ids(V.read_version(spark, path)) == [0, 1, 2, 3]


def test_of_two_writers_one_fails(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    V.write_version(spark.range(3), path)

    def slow(df):  # another writer replaces the table meanwhile
        V.replace(spark, path, lambda d: d.where("id = 2"))
        return df.where("id = 1")
    with pytest.raises(V.ConcurrentWrite):
        V.replace(spark, path, slow)
    assert ids(V.read_version(spark, path)) == [2] and V.versions(spark, path) == [1, 2]
    # both past the check: the file system creates the commit file for one of them
    real, late = V.current_version, []

    def seen_before(s, p):
        if not late:
            return real(s, p)
        return 2
    late.append(1)
    monkeypatch.setattr(V, "current_version", seen_before)
    monkeypatch.setattr(V, "_highest_claimed", lambda *_: 2)
    assert V.write_version(spark.range(7), path, expected=2) == 3
    with pytest.raises(V.ConcurrentWrite):
        V.write_version(spark.range(8), path, expected=2)
    monkeypatch.undo()
    assert ids(V.read_version(spark, path)) == list(range(7))
    assert len([p for p in (tmp_path / "t").iterdir() if p.name.startswith("data-")]) == 3


SCHEMA = T.StructType([T.StructField("code", T.StringType()), T.StructField("n", T.IntegerType()), T.StructField("name", T.StringType())])


def test_quarantine(spark, tmp_path):
    good = [b"AA,1,Alpha", b'BB,2,"Beta, Inc."', b'CC,x,"say ""hi"""', b"DD,,", b"EE,3,caf\xc3\xa9", b'"FF",4,G H', b"GG,5,  padded "]
    bad = [(b"AA,1", "too few cells"), (b"only", "too few cells"), (b"AA,1,a,b", "too many cells"), (b'AA,1,"a,b",c', "too many cells"),
           (b'AA,"1,Alpha', "open quote"), (b'AA,1,"Alpha', "open quote"), (b"AA,1,caf\xe9", "bad encoding"), (b"\xff\xfe,1", "bad encoding")]
    folder = tmp_path / "in"
    folder.mkdir()
    lines = [*good, *[b for b, _ in bad]]
    random.Random(1).shuffle(lines)
    (folder / "a.csv").write_bytes(b"code,n,name\n" + b"\n".join(lines[:9]) + b"\n\n")
    (folder / "b.csv").write_bytes(b"code,n,name\r\n" + b"\r\n".join(lines[9:]))
    rows, rejects = FS.read_quarantined(spark, str(folder), SCHEMA)
    assert rows.schema == SCHEMA
    assert sorted(tuple(r) for r in rows.collect() if r.n) == [
        ("AA", 1, "Alpha"), ("BB", 2, "Beta, Inc."), ("EE", 3, "café"), ("FF", 4, "G H"), ("GG", 5, "  padded ")]
    got = sorted((r.line, r.reason) for r in rejects.collect())
    assert sorted(x for _, x in got) == sorted(r for _, r in bad)
    assert {r.file.rsplit("/", 1)[1] for r in rejects.collect()} == {"a.csv", "b.csv"}
    for raw, reason in bad:
        if reason in ("too few cells", "too many cells"):
            assert (raw.decode(), reason) in got
    assert rows.count() + rejects.count() == len(lines)
    narrow, again = FS.read_quarantined(spark, str(folder), T.StructType(SCHEMA.fields[:1]))
    assert narrow.count() == len(good) and again.count() == len(bad)
    with pytest.raises(FileNotFoundError):
        FS.read_quarantined(spark, str(tmp_path / "none"), SCHEMA)


def flights(spark, n=600, seed=1):
    rng = random.Random(seed)
    start = datetime.date(2014, 12, 20)
    rows = []
    for i in range(n):
        day = start + datetime.timedelta(days=rng.randint(0, 80)) if rng.random() > 0.05 else None
        rows.append((i, rng.choice(["N1", "N2", "N3", None]), rng.choice(["JFK", "LAX", None]), day, rng.choice([1, 2, None])))
    return spark.createDataFrame(rows, "id int, TAIL_NUMBER string, ORIGIN_AIRPORT string, FLIGHT_DATE date, DEPARTURE_HOUR int")


def test_counts_by_month_equal_a_full_rebuild(spark, tmp_path):
    all_ = flights(spark).cache()
    month = INC.month_of(F.col("FLIGHT_DATE"))
    months = sorted(r[0] for r in all_.select(month).distinct().collect() if r[0])
    assert len(months) == 4
    batches = [all_.where(month == m) for m in months[:3]] + [all_.where(f"id % 2 = 0 AND {12 * 2015 + 2} = YEAR(FLIGHT_DATE) * 12 + MONTH(FLIGHT_DATE) - 1"),
               all_.where(f"FLIGHT_DATE IS NULL OR (id % 2 = 1 AND {12 * 2015 + 2} = YEAR(FLIGHT_DATE) * 12 + MONTH(FLIGHT_DATE) - 1)")]
    tails, cong = str(tmp_path / "tails"), str(tmp_path / "cong")
    seen = None
    for b in batches:
        INC.update_tail_counts(b, tails)
        INC.update_congestion(b, cong)
        seen = b if seen is None else seen.unionByName(b)
        want = FT.tail_count_groups(seen)
        assert sorted(map(tuple, INC.read_counts(spark, tails).select(*want.columns).collect())) == sorted(map(tuple, want.collect()))
    want = FT.congestion_groups(all_)
    assert sorted(map(tuple, INC.read_counts(spark, cong).select(*want.columns).collect())) == sorted(map(tuple, want.collect()))
    # an empty batch changes nothing; some months can be read alone
    INC.update_tail_counts(all_.limit(0), tails)
    part = INC.read_counts(spark, tails, months[:1])
    assert {r[0] for r in part.select(month).distinct().collect()} == {months[0]}
    got = FT.add_tail_counts(all_, groups=INC.read_counts(spark, tails)).orderBy("id").collect()
    assert got == FT.add_tail_counts(all_).orderBy("id").collect()
    # weeks that span two months were taken anew
    span = FT.tail_count_groups(all_).groupBy("TAIL_NUMBER", iso_year("FLIGHT_DATE"), iso_week("FLIGHT_DATE")).agg(F.count_distinct(month).alias("m"))
    assert span.where("m > 1").count() > 2


def test_an_untouched_month_keeps_its_files(spark, tmp_path):
    path = str(tmp_path / "t")
    day = lambda m, d: datetime.date(2015, m, d)
    frame = lambda days: spark.createDataFrame([("N1", d) for d in days], "TAIL_NUMBER string, FLIGHT_DATE date")
    INC.update_tail_counts(frame([day(1, 5), day(6, 30)]), path)
    before = INC._folders(INC._stored(spark, path)[1])
    INC.update_tail_counts(frame([day(7, 1)]), path)
    after = INC._folders(INC._stored(spark, path)[1])
    jan, jun = 2015 * 12, 2015 * 12 + 5
    assert after[jan] == before[jan] and after[jun] != before[jun] and jun + 1 in after
    assert {r.FLIGHT_DATE: r[FT.PER_WEEK] for r in INC.read_counts(spark, path).collect()} == {day(1, 5): 1, day(6, 30): 2, day(7, 1): 2}


def model_rows(spark, n=400, seed=3):
    rng = random.Random(seed)
    rows = [(i, *[float(rng.randint(0, 20)) for _ in S.MODEL_FEATURES], int(rng.random() < 0.4)) for i in range(n)]
    return spark.createDataFrame(rows, "id int, " + ", ".join(f"{c} double" for c in S.MODEL_FEATURES) + f", {S.MODEL_TARGET} int")


def test_stored_models_score_alike_and_refuse_changed_input(spark, tmp_path):
    table, path = model_rows(spark), str(tmp_path / "models")
    fit = dict(forest_trees=4, forest_depth=4, sample_fraction=None, max_fit_rows=None)
    trained = M.train_models(table, ["id"], **fit)
    assert MS.save_models(trained, table, path, ["id"]) == 1
    other = spark.newSession()
    moved = other.createDataFrame(table.collect(), table.schema).repartition(5)
    loaded = MS.load_models(other, path, moved)
    score = lambda t, d: sorted((r.id, r.delay_probability, r.is_train, r.prediction) for r in M.delay_scores(t, d).collect())
    assert score(loaded, moved) == score(trained, table)
    assert loaded.test.count() == trained.test.count() and loaded.n_fit == trained.n_fit
    changed = table.withColumn("DISTANCE", F.when(F.col("id") == 7, F.lit(-1.0)).otherwise(F.col("DISTANCE")))
    for bad in (changed, table.where("id > 0"), table.unionByName(table.limit(1)), table.withColumn("DISTANCE", F.col("DISTANCE").cast("float"))):
        with pytest.raises(MS.ChangedInput):
            MS.load_models(spark, path, bad)
    assert len(score(MS.load_models(spark, path, changed, check=False), changed)) == 400
    again = MS.fit_or_load(changed, path, ["id"], **fit)
    assert again.n_fit == trained.n_fit and V.versions(spark, path) == [1, 2]
    assert MS.fit_or_load(changed, path, ["id"]).models and V.versions(spark, path) == [1, 2]


def test_fingerprint_sees_nulls_and_types(spark):
    a = spark.createDataFrame([(1, None), (None, 1)], "x int, y int")
    b = spark.createDataFrame([(None, 1), (None, 1)], "x int, y int")
    assert MS.fingerprint(a) != MS.fingerprint(b) and MS.fingerprint(a) == MS.fingerprint(a.repartition(3))
    assert MS.fingerprint(a) != MS.fingerprint(a.withColumn("x", F.col("x").cast("long")))
    assert MS.fingerprint(a.limit(0)) == MS.fingerprint(b.limit(0))
