"""Landed files to curated tables as a stream: stopped, replayed and repeated micro-batches."""

import pytest
from pyspark.sql import functions as F
from test_pipeline import tables  # noqa: F401  (the provider's people)

from rosterloom.operators import matching, validation
from rosterloom.plans import pipeline
from rosterloom.sources import snapshots, store
from rosterloom.streaming import jobs
from rosterloom.tables import CURATED

HEADER = "first_name,last_name,email,company,location,linkedin_url,consent\n"


def land(folder, name, *rows):
    folder.mkdir(exist_ok=True)
    (folder / f"{name}.csv").write_text(HEADER + "".join(f"{r},,,,,\n" for r in rows))


def run(spark, people, landed, root, state):
    at = F.lit("2024-01-02").cast("timestamp")
    build = pipeline.uploaded(people, matching.name_candidates(people), at)
    jobs.curated_stream(spark, str(landed), str(root), str(state), build, batch_of=F.regexp_extract(
        "path", r"([^/]+)\.csv", 1)).awaitTermination()


def shown(spark, root):
    every = {n: sorted(repr(r) for r in store.read_curated(spark, str(root), n).collect())
             for n in CURATED}
    every["results"] = store.lookup_results(spark, str(root)).count()
    every["rejected"] = store.read_export(spark, str(root)).count()
    every["manifest"] = store.read_manifests(spark, str(root)).count()
    return every


def test_stopped_and_replayed_micro_batches_leave_the_same_tables(  # noqa: F811
        spark, tables, tmp_path, monkeypatch):
    people, landed, root = tables["people"], tmp_path / "landed", tmp_path / "root"
    land(landed, "b1", "John,Doe", "Jane,Smith", ",Nguyen")
    land(landed, "b2", "Alex,Lee")
    commit = snapshots.Publication.commit

    def lost(self, *mark):
        raise RuntimeError("lost before the commit")

    def late(self, *mark):
        commit(self, *mark)
        raise RuntimeError("lost after the commit")

    for stop, visible in ((lost, 0), (late, 4)):
        monkeypatch.setattr(snapshots.Publication, "commit", stop)
        with pytest.raises(Exception, match="lost"):
            run(spark, people, landed, root, tmp_path / "state")
        assert store.read_curated(spark, str(root), "fact_lookup").count() == visible
    monkeypatch.setattr(snapshots.Publication, "commit", commit)
    run(spark, people, landed, root, tmp_path / "state")
    assert snapshots.snapshot(spark, str(root)).number == 1  # the replay was recognised

    run(spark, people, landed, tmp_path / "whole", tmp_path / "whole-state")
    first = shown(spark, root)
    assert first == shown(spark, tmp_path / "whole")
    assert (first["results"], first["rejected"], first["manifest"]) == (3, 1, 2)

    # The same batch delivered again below another path is left out, a new one is built.
    land(landed / "again", "b1", "John,Doe")
    land(landed, "b3", "John,Doe")
    run(spark, people, landed, root, tmp_path / "state")
    after = shown(spark, root)
    assert after["results"] == 4 and after["manifest"] == 3
    assert set(first["fact_lookup"]) < set(after["fact_lookup"])

    # A rebuild of a prefix leaves other batches out.
    rejected = validation.split_valid_invalid(tables["rows"])[1]
    pipeline.rebuild(store.lookup_results(spark, str(root)), rejected, str(tmp_path / "some"),
                     F.lit("2024-01-02").cast("timestamp"), "recorded", "b1")
    assert {r["batch_id"] for r in store.read_curated(
        spark, str(tmp_path / "some"), "fact_lookup").collect()} == {"b1"}
