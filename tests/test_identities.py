"""The index from identities to batches."""

import glob

import pytest
from pyspark.sql import functions as F

from rosterloom.operators import erasure
from rosterloom.sources import identities, snapshots
from rosterloom.sources.snapshots import Publication

ROWS = ("batch_id string, batch_date string, row_number int, first_name string, last_name string, "
        "email string")
REQUEST = "request_id string, person_id string, email string, first_name string, last_name string"


def layers(spark, batches):
    """Valid rows, rejected rows and results of batches with ten people each, some in several."""
    rows = [(f"b{b:02d}", f"2024-01-{b + 1:02d}", i, f"first{(b + i) % 12}", f"last{(b * i) % 7}",
             f"user{b * 5 + i}@example.com") for b in batches for i in range(10)]
    df = spark.createDataFrame(rows, ROWS)
    valid = df.filter("row_number < 5")
    rejected = df.filter("row_number >= 8").select(
        "batch_id", "batch_date", "row_number", F.struct("email", "first_name", "last_name")
        .alias("raw"))
    results = df.filter("row_number < 8").withColumn("profile", F.struct(F.when(
        F.col("row_number") % 2 == 0, F.concat(F.lit("p"), F.substring("email", 5, 2))).alias("id")))
    return valid, rejected, results


def publish(spark, root, batches):
    publication = Publication(spark, root)
    identities.add(erasure.identity_entries(*layers(spark, batches)), publication)
    publication.commit()


def asked(spark, *rows):
    return spark.createDataFrame([(f"r{i}", *row) for i, row in enumerate(rows)], REQUEST)


SUBJECTS = [(None, " USER12@example.com", None, None), ("p10", None, None, None),
            (None, None, "FIRST3", "last2"), (None, None, "first3", None),
            (None, "nobody@example.com", None, None), ("p14", "user3@example.com", "first1", "last1")]


def found(df):
    return sorted(tuple(r) for r in df.collect())


def test_levels_carry_and_a_request_opens_few_folders(spark, folder):
    one = erasure.request_keys(asked(spark, (None, "user12@example.com", None, None)))
    for number in range(1, 7):
        publish(spark, folder, [number])
        levels = identities._levels(snapshots.snapshot(spark, folder))
        assert levels == [i for i in range(4) if number >> i & 1]
        folders = identities.opened(spark, folder, one)
        assert all(len(f) <= 1 for f in folders.values())
    snapshots.vacuum(spark, folder)
    assert not glob.glob(f"{folder}/data/identities_0/**/*.parquet", recursive=True)
    assert len(glob.glob(f"{folder}/data/identities_2/*/bucket=*")) <= identities.BUCKETS
    # After the clean-up everything is still found.
    assert found(identities.batches(spark, folder, asked(
        spark, (None, "user12@example.com", None, None)))) == [("2024-01-02", "b01"), ("2024-01-03", "b02")]


def test_index_finds_what_the_layers_hold(spark, folder):
    for part in ([0, 3, 6], [1, 4], [2, 5, 7]):
        publish(spark, folder, part)
    tables = layers(spark, range(8))
    for subject in [SUBJECTS, *[[s] for s in SUBJECTS]]:
        requests = asked(spark, *subject)
        whole = erasure.subject_match(requests, *tables)
        assert found(identities.subject_match(requests, folder, *tables)) == found(whole)
        days = {d for d, _ in found(identities.batches(spark, folder, requests))}
        held = {f"2024-01-{int(r['batch_id'][1:]) + 1:02d}" for r in whole.collect()}
        assert days == held  # no date is opened in vain here


def test_a_batch_built_again_only_adds(spark, folder):
    publish(spark, folder, [1])
    publish(spark, folder, [1, 2])
    assert found(identities.batches(spark, folder, asked(spark, SUBJECTS[0]))) == [
        ("2024-01-02", "b01"), ("2024-01-03", "b02")]


def test_what_is_erased_is_forgotten_and_the_rest_stays(spark, folder):
    for part in ([0, 1], [2], [3]):
        publish(spark, folder, part)
    tables = layers(spark, range(4))
    subject = asked(spark, (None, "user12@example.com", None, None))
    matches = erasure.subject_match(subject, *tables)
    touched = matches.select("batch_id").distinct()
    before = [erasure.affected(t, touched) for t in tables]
    after = [erasure.erase_rows(t, matches, part)
             for t, part in zip(before, ("row", "rejected", "row"))]
    everyone = asked(spark, *[(None, f"user{i}@example.com", None, None) for i in range(25)
                              if i != 12])
    others = found(identities.batches(spark, folder, everyone))
    identities.forget(spark, folder, erasure.identity_entries(*before),
                      erasure.identity_entries(*after))
    assert found(identities.batches(spark, folder, subject)) == []
    assert found(identities.batches(spark, folder, everyone)) == others
    key = erasure.request_keys(subject).first()[0]
    for path in glob.glob(f"{folder}/data/identities_*/*/bucket=*"):
        assert spark.read.parquet(path).filter(F.col("key") == key).count() == 0


@pytest.mark.parametrize("rows", [[], [(None, None, None, None)], [(None, "", " ", "x")]])
def test_requests_that_name_nobody_and_an_empty_index(spark, folder, rows):
    requests = spark.createDataFrame([("r", *r) for r in rows], REQUEST)
    assert found(identities.batches(spark, folder, requests)) == []
    publish(spark, folder, [1])
    assert found(identities.batches(spark, folder, requests)) == []
