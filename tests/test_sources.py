"""Reading, writing, resuming, reports and draws."""

import glob

import pytest
from pyspark.sql import functions as F

from wardline.operators import posterior
from wardline.sources import schemas, tables


@pytest.fixture
def results(spark):
    return spark.range(1000).select(F.col("id").alias("entity"), (F.col("id") * 2).alias("x"))


def test_round_trip_with_schema(spark, tmp_path, results):
    path = str(tmp_path / "t.parquet")
    tables.write_table(results, path)
    back = tables.read_table(spark, path, results.schema, ["entity"])
    assert back.columns == ["entity"] and back.count() == 1000
    both = tables.read_tables(spark, str(tmp_path), ["t"], {"t": results.schema})
    assert both["t"].exceptAll(results).count() == 0
    tables.write_table(results.withColumn("p", F.col("x") % 3), str(tmp_path / "p"), ["p"])
    assert len(glob.glob(str(tmp_path / "p" / "p=*"))) == 3


def test_results_are_bucketed_not_one_file_each(spark, tmp_path, results):
    path = str(tmp_path / "r")
    tables.write_results(results, path, "entity", buckets=4)
    assert len(glob.glob(path + "/bucket=*")) == 4
    assert len(glob.glob(path + "/*/*.parquet")) < 40
    assert tables.gather_results(spark, path).exceptAll(results).count() == 0


def test_resume(spark, tmp_path, results):
    path = str(tmp_path / "done")
    todo = results.select("entity")
    assert tables.remaining(todo, path, "entity").count() == 1000
    tables.write_results(results.filter("entity < 400"), path, "entity")
    left = tables.remaining(todo, path, "entity")
    assert left.count() == 600 and left.agg(F.min("entity")).first()[0] == 400
    tables.write_results(results.join(left, "entity"), path, "entity")
    assert tables.remaining(todo, path, "entity").count() == 0


def test_report(spark, tmp_path):
    path = str(tmp_path / "report")
    tables.write_report(spark.createDataFrame([("b", 2), ("a", 1)], "name string, n int"), path, ["name"])
    back = spark.read.csv(path, header=True)
    assert back.columns == ["name", "n"] and sorted(r.name for r in back.collect()) == ["a", "b"]


class _Session:
    """Stands for a session that names a checkpoint folder, or a cluster that does not."""

    def __init__(self, named, master):
        self.conf = {tables.CHECKPOINT_DIR: named} if named else {}
        self.sparkContext = type("C", (), {"master": master, "getConf": lambda s: {}})()


def test_shared_folder():
    assert tables.shared_folder(_Session("/shared/x/", "yarn")) == "/shared/x"
    with pytest.raises(ValueError):
        tables.shared_folder(_Session(None, "yarn"))


def test_materialise(spark, tmp_path, results):
    kept = tables.materialise(results, "step", str(tmp_path))
    assert kept.exceptAll(results).count() == 0 and "step-" in kept.inputFiles()[0]
    assert tables.shared_folder(spark) == tables.shared_folder(spark)
    assert tables.materialise(results, "step").count() == 1000


def test_draws(spark, tmp_path):
    head = "lp__,rho,alpha.1,alpha.2,L_C.1.1,L_C.2.1,L_C.1.2,L_C.2.2"
    text = f"# sampler\n{head}\n# adapted\n-1,0.5,1,2,1,0.6,0,0.8\n-2,0.7,3,4,1,0,0,1\n"
    paths = {}
    for chain in (1, 2):
        paths[chain] = str(tmp_path / f"c{chain}.csv")
        with open(paths[chain], "w") as f:
            f.write(text)
    draws = tables.read_draws(spark, paths, ["rho", "alpha", "L_C"])
    assert draws.count() == 2 * 2 * 7
    means = {(r.param, r.i, r.j): r["mean"] for r in posterior.posterior_mean(draws, ["param", "i", "j"]).collect()}
    assert means[("rho", None, None)] == pytest.approx(0.6)
    assert means[("alpha", 2, None)] == 3 and means[("L_C", 2, 1)] == pytest.approx(0.3)
    factors = (
        draws.filter("param = 'L_C'")
        .groupBy("chain", "iter")
        .agg(F.sort_array(F.collect_list(F.struct("i", "j", "value"))).alias("f"))
        .select(F.transform("f", lambda c: c["value"]).alias("factor"))
    )
    cov = {(r.i, r.j): r.value for r in posterior.mean_covariance(factors, "factor", 2).collect()}
    assert cov == {(1, 1): 1.0, (1, 2): pytest.approx(0.3), (2, 1): pytest.approx(0.3), (2, 2): pytest.approx(1.0)}
    shown = posterior.labelled_triangle(posterior.mean_covariance(factors, "factor", 2), ["a", "b"])
    assert {(r.row, r.column): r.value for r in shown.collect()}[("a", "b")] == 0.0
    text = posterior.labelled_triangle(posterior.mean_covariance(factors, "factor", 2), ["a", "b"], lower=False)
    assert {(r.row, r.column): r.value for r in text.collect()} == {
        ("a", "a"): "", ("a", "b"): "0.3", ("b", "a"): "", ("b", "b"): ""
    }


def test_schemas_parse():
    assert len(schemas.first_database()) == 23 and len(schemas.second_database()) == 9


def test_steps_are_deleted_with_their_scope(spark, frame, tmp_path):
    import os

    df = frame([(1,), (2,)], "a int")
    outer = tables.materialise(df, "outer", str(tmp_path))
    with tables.step_scope(spark) as steps:
        first = tables.materialise(outer, "first", str(tmp_path))
        with tables.step_scope(spark):
            inner = tables.materialise(first, "inner", str(tmp_path))
            tables.write_table(inner, f"{tmp_path}/result")
        assert len(steps) == 1 and first.count() == 2
    left = {n.split("-")[0] for n in os.listdir(tmp_path)}
    assert left == {"outer", "result"} and spark.read.parquet(f"{tmp_path}/result").count() == 2


def test_steps_of_a_failure_are_listed(spark, frame, tmp_path):
    import os

    with pytest.raises(ZeroDivisionError) as caught, tables.step_scope(spark) as steps:
        tables.materialise(frame([(1,)], "a int"), "kept", str(tmp_path))
        1 / 0
    assert steps and all(os.path.isdir(p) for p in steps)
    assert steps[0] in caught.value.__notes__[0]


def test_killed_and_repeated_batches_give_each_entity_once(spark, frame, tmp_path, monkeypatch, rows):
    path = f"{tmp_path}/out"
    todo = frame([(k,) for k in range(6)], "id int")
    assert tables.remaining_batches(todo, path, "id").count() == 6

    def run(batch, ids):
        entities = frame([(k,) for k in ids], "id int")
        results = entities.filter("id <> 3").selectExpr("id", "id * 10 AS v", "explode(array(1, 2)) AS n")
        return tables.write_batch(results, entities, path, "id", batch, buckets=2)

    assert run("a", [0, 1])
    with monkeypatch.context() as broken:
        broken.setattr(tables, "write_table", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            run("b", [2, 3])
    assert rows(tables.remaining_batches(todo, path, "id")) == [(2,), (3,), (4,), (5,)]
    assert {r.id for r in tables.gather_batches(spark, path).collect()} == {0, 1}
    assert run("b", [2, 3]) and not run("b", [2, 3]) and not run("a", [0, 1])
    assert rows(tables.remaining_batches(todo, path, "id")) == [(4,), (5,)]
    assert rows(tables.gather_batches(spark, path), "id", "n") == [(k, n) for k in (0, 1, 2) for n in (1, 2)]
