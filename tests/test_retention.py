"""Clean-up of tables that expire."""

import glob
from datetime import datetime, timedelta

import pytest

from rosterloom import vocabulary as V
from rosterloom.sources import retention, snapshots
from rosterloom.sources.snapshots import ConcurrentPublication, Publication

NOW = datetime(2024, 6, 1, 12)


def stored(spark, root, ages):
    """Tables named in ``ages`` (table -> ages of its rows as time spans, or None)."""
    publication = Publication(spark, root)
    for rule in retention.RULES:
        rows = [(i, None if a is None else NOW - a) for i, a in enumerate(ages.get(rule.table, []))]
        if rows:
            retention.add(spark.createDataFrame(rows, f"id long, {rule.age} timestamp"), rule,
                          publication)
    publication.commit()


def left(spark, root, table):
    age = retention.AGES[table]
    rows = retention.read(spark, root, table, f"id long, {age} timestamp").collect()
    return sorted(r["id"] for r in rows)


def days(n, **more):
    return timedelta(days=n, **more)


def test_every_expiring_table_has_a_rule():
    assert {r.table: r.days for r in retention.RULES} == V.RETENTION_DAYS


def test_each_table_by_its_own_limit(spark, folder):
    stored(spark, folder, {rule.table: [
        days(rule.days, hours=30), days(rule.days, seconds=1), days(rule.days),
        days(rule.days) - timedelta(microseconds=1), days(rule.days, hours=-11),
        days(rule.days, hours=-30), days(0), None] for rule in retention.RULES})
    before = {f for f in glob.glob(f"{folder}/data/**/*.parquet", recursive=True)}
    touched = retention.clean_up(spark, folder, NOW)
    for rule in retention.RULES:
        assert left(spark, folder, rule.table) == [3, 4, 5, 6, 7]
        assert len(touched[rule.table]) == 2
    after = {f for f in glob.glob(f"{folder}/data/**/*.parquet", recursive=True)}
    # Younger dates lie where they were; nothing older is left.
    young = {f for f in before if "batch_date=none" in f or "batch_date=2024-06-01" in f}
    assert young <= after
    for rule in retention.RULES:
        edge = rule.limit(NOW).strftime("%Y-%m-%d")
        shown = [f.split("batch_date=")[1][:10] for f in after if f"/data/{rule.table}/" in f]
        assert all(d.startswith("none") or d >= edge for d in shown)
    assert retention.clean_up(spark, folder, NOW + timedelta(minutes=1))["raw"] == ["2024-03-03"]


def test_nothing_to_do_makes_no_commit(spark, folder):
    assert retention.clean_up(spark, folder, NOW) == {}
    stored(spark, folder, {"raw": [days(1), None]})
    number = snapshots.snapshot(spark, folder).number
    assert retention.clean_up(spark, folder, NOW) == {}
    assert snapshots.snapshot(spark, folder).number == number
    assert left(spark, folder, "raw") == [0, 1]


def test_a_table_may_expire_whole(spark, folder):
    stored(spark, folder, {"landing": [days(31), days(45)], "raw": [days(31)]})
    assert set(retention.clean_up(spark, folder, NOW)) == {"landing"}
    assert left(spark, folder, "landing") == [] and left(spark, folder, "raw") == [0]
    assert not glob.glob(f"{folder}/data/landing/**/*.parquet", recursive=True)


def test_readers_of_the_commit_before_until_the_switch(spark, folder, monkeypatch):
    stored(spark, folder, {"landing": [days(31), days(1)]})
    monkeypatch.setattr(Publication, "commit", lambda self: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        retention.clean_up(spark, folder, NOW)
    assert left(spark, folder, "landing") == [0, 1]


def test_a_publication_that_comes_between_is_not_overwritten(spark, folder, monkeypatch):
    stored(spark, folder, {"landing": [days(31), days(1)]})
    put, done = Publication.put_days, []

    def between(self, *args, **kwargs):
        if not done:
            done.append(1)
            Publication(spark, folder).commit()
        return put(self, *args, **kwargs)

    monkeypatch.setattr(Publication, "put_days", between)
    with pytest.raises(ConcurrentPublication):
        retention.clean_up(spark, folder, NOW)
    assert left(spark, folder, "landing") == [0, 1]


def test_raw_folders(spark, folder):
    rows = [("p", "2024-03-02", "a"), ("p", "2024-03-03", "b"), ("q", "2024-01-01", "c")]
    (spark.createDataFrame(rows, "provider string, batch_date string, value string")
     .write.partitionBy("provider", "batch_date").text(f"{folder}/raw"))
    assert retention.expire_raw(spark, f"{folder}/raw", NOW) == [
        "provider=p/batch_date=2024-03-02", "provider=q/batch_date=2024-01-01"]
    assert [r.value for r in spark.read.text(f"{folder}/raw").collect()] == ["b"]
    assert retention.expire_raw(spark, f"{folder}/none", NOW) == []
