"""Tables in and out: scans, materialised steps, resumable results, reports and draws."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

CHECKPOINT_DIR = "spark.checkpoint.dir"


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """A Parquet table; with a schema no file footer is read to infer one."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.parquet(path)
    return df.select(*columns) if columns else df


def read_tables(
    spark: SparkSession,
    folder: str,
    names: Iterable[str],
    schemas: Mapping[str, T.StructType] | None = None,
) -> dict[str, DataFrame]:
    """Tables by name from ``<folder>/<name>.parquet``."""
    schemas = schemas or {}
    return {n: read_table(spark, f"{folder}/{n}.parquet", schemas.get(n)) for n in names}


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode="overwrite") -> None:
    writer = df.write.mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def shared_folder(spark: SparkSession) -> str:
    """The shared folder the cluster names for checkpoints.

    Only a local session without the setting gets a temporary folder of its own.
    """
    context = spark.sparkContext
    named = spark.conf.get(CHECKPOINT_DIR, None) or context.getConf().get(CHECKPOINT_DIR)
    if not named and not context.master.startswith("local"):
        raise ValueError(f"{CHECKPOINT_DIR} must name a folder every executor can reach")
    if not named:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(tempfile.mkdtemp(prefix="wardline-"))
        named = context.getCheckpointDir()
    return named.rstrip("/")


# The open step scopes, innermost last: paths of the steps written inside each.
_SCOPES: ContextVar[tuple[list[str], ...]] = ContextVar("scopes", default=())


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    place, system = _file_system(spark, path)
    return system.exists(place)


def note_step(path: str) -> str:
    """Puts a folder written elsewhere under the innermost open scope."""
    for scope in _SCOPES.get()[-1:]:
        scope.append(path)
    return path


@contextmanager
def step_scope(spark: SparkSession) -> Iterator[list[str]]:
    """Owns the steps written inside the block and deletes them at its end.

    Results are read from steps as long as they are not written themselves, so write or collect them inside::

        with step_scope(spark):
            write_table(query(spark, folder), target)

    Scopes nest; each deletes its own steps. When the block fails its steps stay, for a look or another try, and the error
    lists them.
    """
    steps: list[str] = []
    token = _SCOPES.set((*_SCOPES.get(), steps))
    try:
        yield steps
    except BaseException as error:
        if steps:
            error.add_note("steps left: " + ", ".join(steps))
        raise
    else:
        for path in steps:
            place, system = _file_system(spark, path)
            system.delete(place, True)
        steps.clear()
    finally:
        _SCOPES.reset(token)


def materialise(
    df: DataFrame, name: str, folder: str | None = None, partition_by: Sequence[str] = ()
) -> DataFrame:
    """Writes a step that several later steps read, and reads it back.

    The written table cuts the lineage and survives lost executors. It belongs to the innermost ``step_scope``;
    outside of any it stays.
    """
    spark = df.sparkSession
    path = note_step(f"{folder or shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}")
    write_table(df, path, partition_by)
    return spark.read.schema(df.schema).parquet(path)


def write_results(df: DataFrame, path: str, entity: str, buckets: int = 64, mode="append") -> None:
    """Per-entity results as one data set in hash folders, not one file per entity.

    The rebalance hint gathers each folder's rows into few files and lets Spark split the
    folder of a hot entity over several tasks.
    """
    bucket = F.pmod(F.xxhash64(entity), F.lit(buckets)).cast("int")
    df.withColumn("bucket", bucket).hint("rebalance", "bucket").write.mode(mode).partitionBy(
        "bucket"
    ).parquet(path)


def gather_results(spark: SparkSession, path: str) -> DataFrame:
    """All entities' results; the entity is a column, so nothing has to be parsed or bound."""
    return spark.read.parquet(path).drop("bucket")


def remaining(todo: DataFrame, path: str, entity: str) -> DataFrame:
    """Entities without results yet; all of them where nothing has been written.

    Only a missing folder counts as nothing written; a broken one raises.
    """
    from wardline.operators.joins import exclude

    try:
        done = gather_results(todo.sparkSession, path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return todo
    return exclude(todo, done, entity)


def write_batch(
    df: DataFrame, entities: DataFrame, path: str, entity: str, batch: str, buckets: int = 64
) -> bool:
    """Results of one batch of entities with a commit record; False where the batch is finished already.

    The results go to a folder of the batch, which another try replaces as a whole. Only then is the record
    of the batch written: the ids of all its ``entities``, also of those without a result row. What a killed run left
    without a record does not count, so a repeated run has each entity once.
    """
    spark = df.sparkSession
    record = f"{path}/finished/batch={batch}"
    if exists(spark, f"{record}/_SUCCESS"):
        return False
    write_results(df, f"{path}/results/batch={batch}", entity, buckets, mode="overwrite")
    write_table(entities.select(entity).distinct(), record)
    return True


def finished_entities(spark: SparkSession, path: str) -> DataFrame | None:
    """``(entity, batch)`` of the commit records, None before the first; results are not read."""
    if not exists(spark, f"{path}/finished"):
        return None
    return spark.read.parquet(f"{path}/finished")


def gather_batches(spark: SparkSession, path: str) -> DataFrame:
    """The results of all finished batches; folders without a record are left out before they are read."""
    done = [r.batch for r in spark.read.parquet(f"{path}/finished").select("batch").distinct().collect()]
    results = spark.read.parquet(f"{path}/results")
    return results.filter(F.col("batch").isin(done)).drop("batch", "bucket")


def remaining_batches(todo: DataFrame, path: str, entity: str) -> DataFrame:
    """Entities without a commit record; all of them before the first."""
    from wardline.operators.joins import exclude

    done = finished_entities(todo.sparkSession, path)
    return todo if done is None else exclude(todo, done.select(entity), entity)


def write_report(df: DataFrame, path: str, order_by: Sequence[str] = ()) -> None:
    """A report table as CSV with a header. Sorted only here, at the sink."""
    (df.orderBy(*order_by) if order_by else df).write.mode("overwrite").csv(path, header=True)


def read_draws(
    spark: SparkSession, paths: Mapping[int, str], parameters: Sequence[str]
) -> DataFrame:
    """Sampler draws as ``(chain, iter, param, i, j, value)`` for the named parameters.

    Files are CSV with ``#`` comment lines and columns such as ``rho``, ``alpha.2`` and
    ``L_C.1.3``; only the columns of the parameters asked for are read. Chains are given as
    ``{chain: path}``. ``iter`` tells the draws of a chain apart and grows in file order.
    """
    frames = []
    for chain, path in paths.items():
        wide = spark.read.csv(path, header=True, comment="#")
        wanted = [c for c in wide.columns if c.split(".")[0] in parameters]
        cells = []
        for c in wanted:
            name, *index = c.split(".")
            i, j = (index + [None, None])[:2]
            cells.append(
                F.struct(
                    F.lit(name).alias("param"),
                    F.lit(int(i) if i else None).cast("int").alias("i"),
                    F.lit(int(j) if j else None).cast("int").alias("j"),
                    F.col(f"`{c}`").try_cast("double").alias("value"),
                )
            )
        frames.append(
            wide.withColumn("chain", F.lit(chain))
            .withColumn("iter", F.monotonically_increasing_id())
            .select("chain", "iter", F.explode(F.array(*cells)).alias("_d"))
            .select("chain", "iter", "_d.*")
        )
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
