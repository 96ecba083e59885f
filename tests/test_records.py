import pytest
from pyspark.sql import functions as F

from obsflow.operators import models, splitting, tuning
from obsflow.operators.ledger import SearchLedger
from obsflow.operators.splitting import SEED
from obsflow.operators.vectors import VECTOR, assembler
from obsflow.sources.records import get_record, put_record, read_records


@pytest.fixture(scope="module")
def vectors(spark):
    rows = spark.range(1200).selectExpr("id", "CAST(id % 17 AS DOUBLE) AS a", "CAST(id % 29 AS DOUBLE) AS b", "id % 17 * 2.0D + pow(id % 29, 1.5) AS temperature")
    return assembler(["a", "b"], VECTOR).transform(rows).persist()


def test_records(spark, tmp_path):
    path, schema = str(tmp_path / "r"), "name string, value double"
    assert get_record(spark, path, schema) is None and read_records(spark, f"{path}/*", schema).count() == 0
    for value in (1.5, float("nan"), 2.5):
        put_record(spark, f"{path}/one", {"name": "x", "value": value}, schema)
    assert get_record(spark, f"{path}/one", schema).value == 2.5
    (tmp_path / "r" / "two" / "_temporary").mkdir(parents=True)  # what a killed write leaves
    assert read_records(spark, f"{path}/*", schema).count() == 1 and get_record(spark, f"{path}/two", schema) is None


def test_ledger_knows_settings_phase_and_params(spark, tmp_path):
    path = str(tmp_path / "ledger")
    book = SearchLedger(spark, path, "s")
    book.record(1, {"p": "1"}, 0.1 + 0.2)
    book.record(1, {"p": "2"}, float("nan"))
    assert book.known(1, [{"p": "1"}, {"p": "3"}]) == [0.1 + 0.2, None]
    assert book.known(2, [{"p": "1"}]) == [None] and SearchLedger(spark, path, "t").known(1, [{"p": "1"}]) == [None]
    assert [(r["rank"], r.params) for r in book.ranking().orderBy("rank").collect()] == [(1, "p=1"), (2, "p=2")]


def test_rounds_share_a_fit_and_score_as_own_fits(vectors):
    estimator = models.boosted_trees(maxDepth=3, subsamplingRate=0.8)
    evaluator = tuning.RegressionEvaluator(labelCol="temperature")
    grid = tuning.build_grid(estimator, {"maxIter": [2, 5], "stepSize": [0.1, 0.3]})
    assert sorted(map(len, tuning.nested_fits(estimator, evaluator, grid))) == [2, 2]
    full = tuning.nested_fits(estimator, evaluator, tuning.boosted_grid(estimator))
    assert len(full) == 12 and sorted(i for g in full for i in g) == list(range(24))
    forest = models.forest_base()
    assert len(tuning.nested_fits(forest, evaluator, tuning.forest_grid(forest))) == 48
    train, held = (p.persist() for p in vectors.randomSplit([0.8, 0.2], seed=SEED))
    found = tuning.validation_search(estimator, grid, vectors, evaluator)
    assert len(found) == 4
    for candidate in found:
        assert candidate.metric == pytest.approx(evaluator.evaluate(estimator.fit(train, candidate.params).transform(held)), rel=1e-9)


def test_a_stopped_search_goes_on(spark, vectors, tmp_path, monkeypatch):
    fits, ledger, stopping = [], str(tmp_path / "ledger"), [True]
    plain = tuning._metrics_of_one_fit

    def counted(estimator, evaluator, maps, train, held):
        if stopping and len(fits) == 2:
            raise RuntimeError("stopped")
        fits.append(maps)
        return plain(estimator, evaluator, maps, train, held)

    monkeypatch.setattr(tuning, "_metrics_of_one_fit", counted)
    estimator = models.linear()
    grid = tuning.build_grid(estimator, {"regParam": [0.0, 1.0, 10.0], "fitIntercept": [True, False]})
    search = {"fractions": (0.5, 1.0), "top_n": 2, "parallelism": 1, "keys": ["id"]}
    with pytest.raises(RuntimeError):
        tuning.staged_search(estimator, grid, vectors, ledger=ledger, **search)
    assert SearchLedger(spark, ledger).entries().count() == 2
    stopping.clear()
    first = tuning.staged_search(estimator, grid, vectors, ledger=ledger, **search)
    assert len(fits) == 2 + 4 + 2
    again = tuning.staged_search(estimator, grid, vectors.repartition(5, "a"), ledger=ledger, **search)
    assert len(fits) == 8  # nothing but the final fit
    other = tuning.staged_search(estimator, grid, vectors.repartition(5, "a"), **search)
    kept = [[(tuning.described(c.params), pytest.approx(c.metric, rel=1e-9)) for c in phase] for phase in first.phases]
    for found in (again, other):
        assert [[(tuning.described(c.params), c.metric) for c in phase] for phase in found.phases] == kept
    assert [r.phase for r in SearchLedger(spark, ledger).ranking().collect()].count(2) == 2
    # Other settings do not count as known.
    tuning.staged_search(models.linear(maxIter=7), grid, vectors, ledger=ledger, **search)
    assert len(fits) == 8 + 8 + 8


@pytest.mark.parametrize("rows", [0, 1, 7, 777, 4999, 5000, 9000])
def test_exact_sample(spark, rows):
    table = spark.range(5000).selectExpr("id", "if(id % 50 = 0, null, concat('s', id % 40)) AS name")
    taken = sorted(map(tuple, splitting.exact_sample(table, rows).collect()))
    assert len(taken) == len(set(taken)) == min(rows, 5000)
    moved = table.repartition(13, "name")
    assert taken == sorted(map(tuple, splitting.exact_sample(moved, rows, step=5).collect()))
    fast = splitting.exact_sample(table, rows, splitting.fast_bucket)
    assert fast.count() == min(rows, 5000) and fast.columns == table.columns


def test_exact_samples_nest(spark):
    table = spark.range(3000).selectExpr("id", "id % 7 AS other")
    small, large = (set(map(tuple, splitting.exact_sample(table, n).collect())) for n in (100, 400))
    assert small < large


def test_exact_sample_of_equal_rows(spark, monkeypatch):
    monkeypatch.setattr(splitting, "COPIES", 64)
    table = spark.range(2000).selectExpr("if(id < 1500, -1, id) AS v", "CAST(NULL AS STRING) AS w")
    hashes = {r.v: r.h for r in table.distinct().select("v", splitting.md5_bucket(["v", "w"])[0].alias("h")).collect()}
    before = sum(h < hashes[-1] for h in hashes.values())
    for rows in (before, before + 1, before + 700, before + 1500, before + 1501):
        taken = [r.v for r in splitting.exact_sample(table, rows).collect()]
        assert len(taken) == rows and taken.count(-1) == min(max(rows - before, 0), 1500)


def test_exact_sample_with_colliding_hashes(spark):
    table = spark.range(100).selectExpr("id", "id % 3 AS g")
    crowded = lambda keys: (F.col("id") % 4, 2)
    expected = sorted(range(100), key=lambda i: (i % 4, i))
    for rows in (10, 25, 26, 60):
        assert sorted(r.id for r in splitting.exact_sample(table, rows, crowded).collect()) == sorted(expected[:rows])


def test_exact_sample_of_nothing(spark):
    table = spark.createDataFrame([], "a int, b string")
    assert splitting.exact_sample(table, 5).count() == 0
    with pytest.raises(ValueError):
        splitting.exact_sample(table, -1)


def test_hash_sample_nests_and_is_free_of_the_split(spark):
    rows = spark.range(20000).selectExpr("id")
    small, large = ({r.id for r in splitting.hash_sample(rows, f, ["id"], "s").collect()} for f in (0.1, 0.3))
    assert small < large and 1700 < len(small) < 2300
    train, _ = splitting.hash_split(rows, 0.5, ["id"], splitting.md5_bucket)
    assert 800 < len(small & {r.id for r in train.collect()}) < 1200
