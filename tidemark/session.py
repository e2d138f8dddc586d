"""Session helpers: building a local session for tests and finding the shared
scratch folder (``spark.checkpoint.dir``) that jobs write state into."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on. AQE re-plans joins and coalesces shuffle
# partitions from runtime sizes; skew join splits hot keys of a sort-merge join.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(master: str = "local[8]", app: str = "tidemark",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench. On a cluster the session comes
    from spark-submit and only :data:`RECOMMENDED_CONF` should be applied."""
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", "8g")
         # reliable checkpoints (paging) are removed once unreferenced
         .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true"))
    for k, v in {**RECOMMENDED_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scale_conf(shuffled_bytes: int, total_cores: int, partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a cluster run, from the expected bytes *shuffled* (after
    partial aggregation - for the counter jobs that is far below the input)
    and the cluster's cores. Shuffle partitions start high enough that each
    holds about ``partition_bytes`` and never below two waves of cores; AQE
    coalesces small ones at run time and splits skewed join partitions."""
    parts = max(2 * total_cores, -(-shuffled_bytes // partition_bytes))
    size = f"{partition_bytes >> 20}m"
    return {
        **RECOMMENDED_CONF,
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": size,
        "spark.sql.files.maxPartitionBytes": size,
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": f"{2 * (partition_bytes >> 20)}m",
        # startup setting (spark-submit --conf): drop unreferenced checkpoints
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }


def apply_recommended_conf(spark: SparkSession) -> None:
    for k, v in RECOMMENDED_CONF.items():
        spark.conf.set(k, v)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session; only when it is unset (local tests) a private
    folder is created and registered, so ``DataFrame.checkpoint()`` and every
    state table of this library land in the same place."""
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        # SparkContext appends a random sub-folder; state goes next to it.
        return d.rstrip("/")
    conf = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        conf = tempfile.mkdtemp(prefix="tidemark-ckpt-")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir().rstrip("/")


def shared_root(spark: SparkSession) -> str:
    """The configured shared folder itself (``spark.checkpoint.dir``),
    without the per-application sub-folder Spark adds for checkpoints. State
    that must outlive the application - offset log, counters, cell tables,
    snapshots, stream checkpoints - goes here; a restarted application then
    finds it again."""
    # Spark puts its per-application folder directly under the configured
    # one; the parent is the configured folder, fully qualified
    return checkpoint_root(spark).rsplit("/", 1)[0]


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder for query-time state under this application's
    checkpoint folder (not meant to outlive the application)."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives loss of
    executors, unlike a local checkpoint)."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def local_path(path: str) -> str:
    return path[len("file:"):] if path.startswith("file:") else path


def exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop FileSystem of the path, so it works
    on HDFS / object stores as well as locally."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the sub-folders of ``path`` (a directory listing, not data)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the files directly in ``path``; none if it is not there."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    return sorted(n for s in fs.listStatus(p) if s.isFile() and not (n := s.getPath().getName()).startswith("."))


def matches(spark: SparkSession, pattern: str) -> bool:
    """Whether any path fits a glob pattern."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p))


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files under ``path``; 0 if it is not there."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return int(fs.getContentSummary(p).getLength()) if fs.exists(p) else 0


def create_file(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False if it was there (one caller wins)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).createNewFile(p))


def _mounted(spark: SparkSession, path: str) -> str | None:
    """The plain path of a local or mounted file, None elsewhere. Hadoop's
    local file system keeps checksums in files beside, which can't be replaced
    in one step with the file; such files are read and written plainly."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    uri = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toUri()
    return uri.getPath() if uri.getScheme() == "file" else None


def read_small(spark: SparkSession, path: str) -> str:
    """Text of a small file, by the driver."""
    plain = _mounted(spark, path)
    if plain:
        with open(plain, encoding="utf-8") as f:
            return f.read()
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    stream = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(p)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def replace_file(spark: SparkSession, path: str, aside: str, text: str) -> None:
    """Write ``text`` to ``aside`` and rename it over ``path`` in one step.
    That step is atomic where the file system's rename is (HDFS, local and
    mounted ones); object stores need a committer of their own."""
    plain = _mounted(spark, path)
    if plain:
        os.makedirs(os.path.dirname(plain), exist_ok=True)
        with open(_mounted(spark, aside), "w", encoding="utf-8") as f:
            f.write(text)
            f.flush()
            os.fsync(f.fileno())
        os.replace(_mounted(spark, aside), plain)
        return
    sc = spark.sparkContext
    conf, fs = sc._jsc.hadoopConfiguration(), sc._jvm.org.apache.hadoop.fs
    src, dst = fs.Path(aside), fs.Path(path)
    out = src.getFileSystem(conf).create(src, False)
    try:
        out.write(text.encode())
    finally:
        out.close()
    overwrite = sc._gateway.new_array(getattr(fs, "Options$Rename"), 1)
    overwrite[0] = getattr(fs, "Options$Rename").OVERWRITE
    fs.FileContext.getFileContext(src.getFileSystem(conf).getUri(), conf).rename(src, dst, overwrite)


def delete_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def modified_ms(spark: SparkSession, path: str) -> int:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return int(fs.getFileStatus(p).getModificationTime())


def env_cpus(default: int = 8) -> int:
    try:
        return int(os.environ.get("BENCH_CPUS", default))
    except ValueError:
        return default
