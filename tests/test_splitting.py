import hashlib

import pytest
from pyspark.sql import functions as F

from obsflow.operators import splitting


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(5000).selectExpr("id", "concat('s', id % 40) as name", "if(id % 50 = 0, null, id / 8) as v")


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


@pytest.mark.parametrize("bucket", [splitting.md5_bucket, splitting.fast_bucket])
def test_hash_split_is_complete_disjoint_and_stable(rows, bucket):
    train, test = splitting.hash_split(rows, 0.7, bucket=bucket)
    left, right = ids(train), ids(test)
    assert sorted(left + right) == list(range(5000)) and 0.66 < len(left) / 5000 < 0.74
    again, _ = splitting.hash_split(rows.repartition(13, "name").sort(F.desc("v")), 0.7, bucket=bucket)
    assert ids(again) == left


def test_md5_bucket_is_reproducible_elsewhere(rows):
    for r in rows.limit(200).select("*", splitting.md5_bucket(["id", "name"])[0].alias("b")).collect():
        assert r.b == int(hashlib.md5(f"{r.id}|{r.name}".encode()).hexdigest()[:8], 16)


def test_null_keys_have_a_side(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "id int, k string")
    for bucket in (splitting.md5_bucket, splitting.fast_bucket):
        train, test = splitting.hash_split(df, 0.5, ["k"], bucket)
        assert train.count() + test.count() == 2


@pytest.mark.parametrize("ratio", [0.0, 1.0])
def test_extreme_ratios(rows, ratio):
    train, test = splitting.hash_split(rows, ratio)
    assert (train.count(), test.count()) == (round(5000 * ratio), round(5000 * (1 - ratio)))


def test_fine_and_wrong_ratios(spark):
    train, test = splitting.hash_split(spark.range(100_000), 0.999)
    assert 50 < test.count() < 160 and train.count() + test.count() == 100_000
    assert splitting.hash_split(spark.range(1_000_000), 0.99999)[1].count() > 0
    with pytest.raises(ValueError):
        splitting.hash_split(spark.range(3), 1.7)


def test_random_split(rows):
    train, test = splitting.random_split(rows)
    assert sorted(ids(train) + ids(test)) == list(range(5000))
    assert ids(train) == ids(splitting.random_split(rows)[0])


def test_samples_nest(rows):
    small, large = (set(ids(splitting.bernoulli_sample(rows, f))) for f in (0.01, 0.1))
    assert small < large and 350 < len(large) < 650


def test_sample_about(rows):
    assert splitting.sample_about(rows, 5000).count() == 5000
    assert 800 < splitting.sample_about(rows, 1000).count() < 1200


def test_first_rows(rows):
    head = splitting.first_rows(rows, 7, ("id", "name"))
    assert head.count() == 7 and head.columns == ["id", "name"]
