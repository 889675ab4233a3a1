"""Dataset layouts: an episode for each file, many episodes in files of bounded size, and the ways between them.

Rows always go by episode_index, never by their place in a file, and a file's pointer is where its rows were written.
A dataset is a folder with ``meta/info.json``, ``meta/tasks``, ``meta/episodes`` and ``data``; data is partitioned by
chunk and file (or episode) columns, which readers prune by.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import flat_name
from ..operators import meta, stats, trajectory
from . import packing

FILE_MB, CHUNK_FILES = 100, 1000


@dataclass
class Info:
    codebase_version: str
    robot_type: str
    fps: float
    total_episodes: int = 0
    total_frames: int = 0
    total_tasks: int = 0
    chunks_size: int = CHUNK_FILES
    data_files_size_in_mb: int = FILE_MB
    splits: dict = field(default_factory=dict)
    features: dict = field(default_factory=dict)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def write_json(spark: SparkSession, path: str, value: dict) -> None:
    """By a temporary file beside it and a rename, in any Hadoop file system."""
    jvm, at, fs = _fs(spark, path)
    tmp = jvm.org.apache.hadoop.fs.Path(path + ".tmp")
    out = fs.create(tmp, True)
    out.write(bytearray(json.dumps(value, indent=2).encode()))
    out.close()
    # Over the old file in one step: a reader sees the old one or the new one.
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(tmp), fs.makeQualified(at), how)


def read_json(spark: SparkSession, path: str) -> dict:
    return json.loads("\n".join(r[0] for r in spark.read.text(path, wholetext=True).collect()))


def read_info(spark: SparkSession, root: str, version: str | None = None) -> Info:
    """The dataset's info; another version than wanted is an error."""
    info = Info(**read_json(spark, f"{root}/meta/info.json"))
    if version and info.codebase_version != version:
        raise ValueError(f"{root} is {info.codebase_version}, not {version}")
    return info


def episode_table(frames: DataFrame) -> DataFrame:
    """episode_index, length, tasks (task_index by first appearance)."""
    lengths = frames.groupBy("episode_index").agg(F.count("*").alias("length"))
    return lengths.join(stats.tasks_by_episode(frames, "episode_index", "task_index", "frame_index"), "episode_index")


def plan_files(frames: DataFrame, bytes_per_frame: float, limit_mb: float = FILE_MB) -> DataFrame:
    """The episode table with data/chunk_index, data/file_index, dataset_from_index, dataset_to_index."""
    e = episode_table(frames).withColumn("__bytes", F.col("length") * F.lit(float(bytes_per_frame)))
    packed = packing.pack(e, [], "episode_index", "__bytes", limit_mb * (1 << 20), CHUNK_FILES)
    return trajectory.dataset_offsets(packed.drop("__bytes"))


def write_packed(frames: DataFrame, tasks: DataFrame, root: str, info: Info, bytes_per_frame: float, limit_mb: float = FILE_MB) -> DataFrame:
    """Write version v3.0: many episodes for each file. Returns the episode table."""
    spark = frames.sparkSession
    planned = plan_files(frames, bytes_per_frame, limit_mb)
    planned.write.mode("overwrite").parquet(f"{root}/meta/episodes")
    episodes = spark.read.parquet(f"{root}/meta/episodes")
    placed = frames.join(episodes.select("episode_index", "chunk_index", "file_index"), "episode_index")
    placed.repartition("chunk_index", "file_index").sortWithinPartitions("chunk_index", "file_index", "episode_index", "frame_index").write.mode("overwrite").partitionBy("chunk_index", "file_index").parquet(f"{root}/data")
    tasks.write.mode("overwrite").parquet(f"{root}/meta/tasks")
    _finish(spark, root, info, "v3.0", episodes, tasks)
    return episodes


def write_by_episode(frames: DataFrame, tasks: DataFrame, root: str, info: Info) -> DataFrame:
    """Write version v2.1: a file for each episode under its chunk; episodes and tasks as JSON lines."""
    spark = frames.sparkSession
    chunked = frames.withColumns({"chunk": F.floor(F.col("episode_index") / info.chunks_size), "episode": F.col("episode_index")})
    chunked.repartition("episode").sortWithinPartitions("episode", "frame_index").write.mode("overwrite").partitionBy("chunk", "episode").parquet(f"{root}/data")
    episode_table(frames).write.mode("overwrite").json(f"{root}/meta/episodes")
    tasks.write.mode("overwrite").json(f"{root}/meta/tasks")
    episodes = spark.read.schema("episode_index long, length long, tasks array<long>").json(f"{root}/meta/episodes")
    _finish(spark, root, info, "v2.1", episodes, tasks)
    return episodes


def _finish(spark: SparkSession, root: str, info: Info, version: str, episodes: DataFrame, tasks: DataFrame) -> None:
    t = stats.totals(episodes, tasks, chunk_size=info.chunks_size).first()
    done = asdict(info) | {"codebase_version": version, "total_episodes": t.total_episodes, "total_frames": t.total_frames, "total_tasks": t.total_tasks, "splits": {"train": f"0:{t.total_episodes}"}}
    write_json(spark, f"{root}/meta/info.json", done)


def read_frames(spark: SparkSession, root: str) -> DataFrame:
    """Frames of either version, without the columns of the layout."""
    df = spark.read.parquet(f"{root}/data")
    return df.drop("chunk", "episode", "chunk_index", "file_index")


def read_tasks(spark: SparkSession, root: str) -> DataFrame:
    info = read_info(spark, root)
    return spark.read.parquet(f"{root}/meta/tasks") if info.codebase_version == "v3.0" else spark.read.schema("task_index long, task string").json(f"{root}/meta/tasks")


def read_episodes(spark: SparkSession, root: str) -> DataFrame:
    """The episode table of either version in order of its episodes."""
    info = read_info(spark, root)
    found = spark.read.parquet(f"{root}/meta/episodes") if info.codebase_version == "v3.0" else spark.read.json(f"{root}/meta/episodes")
    return found.orderBy("episode_index")


#: The statistics that version v2.1 keeps.
LEGACY_STATS = ("min", "max", "mean", "std", "count")


def legacy_stats(episodes: DataFrame) -> DataFrame:
    """(episode_index, stats): the columns ``stats/feature/statistic`` nested by feature, with version v2.1's statistics only."""
    features: dict[str, list[str]] = {}
    for c in episodes.columns:
        head, _, rest = c.partition("/")
        feature, _, stat = rest.rpartition("/")
        if head == "stats" and stat in LEGACY_STATS:
            features.setdefault(feature, []).append(stat)
    made = [F.struct(*[F.col(f"`stats/{f}/{s}`").alias(s) for s in LEGACY_STATS if s in stats_]).alias(f) for f, stats_ in features.items()]
    return episodes.select("episode_index", F.struct(*made).alias("stats") if made else F.expr("named_struct()").alias("stats"))


def write_legacy_stats(episodes: DataFrame, root: str) -> None:
    """Version v2.1's statistics of the episodes as JSON lines, in their order."""
    legacy_stats(episodes).orderBy("episode_index").write.mode("overwrite").json(f"{root}/meta/episodes_stats")


def read_legacy_stats(spark: SparkSession, root: str) -> DataFrame:
    """(episode_index, feature, statistic, values): version v2.1's statistics, whatever the features; nested lists are flat."""
    raw = spark.read.schema("episode_index long, stats map<string, map<string, string>>").json(f"{root}/meta/episodes_stats")
    long = raw.select("episode_index", F.explode("stats").alias("feature", "all")).select("episode_index", "feature", F.explode("all").alias("statistic", "text"))
    numbers = F.split(F.regexp_replace("text", r"[\[\]\s]", ""), ",")
    return long.select("episode_index", "feature", "statistic", F.transform(F.filter(numbers, lambda x: x != ""), lambda x: x.cast("double")).alias("values"))


def v21_to_v30(spark: SparkSession, source: str, target: str, bytes_per_frame: float, limit_mb: float = FILE_MB) -> DataFrame:
    info = read_info(spark, source, "v2.1")
    return write_packed(read_frames(spark, source), read_tasks(spark, source), target, info, bytes_per_frame, limit_mb)


def v30_to_v21(spark: SparkSession, source: str, target: str) -> DataFrame:
    info = read_info(spark, source, "v3.0")
    return write_by_episode(read_frames(spark, source), read_tasks(spark, source), target, info)


def legacy_columns(episodes: DataFrame) -> DataFrame:
    """Episode columns without those of the packed layout (data/, videos/, stats/, meta/)."""
    return episodes.select(*[c for c in episodes.columns if not c.startswith(("data/", "videos/", "stats/", "meta/"))])


def rename_features(df: DataFrame, names: dict[str, str] | None = None) -> DataFrame:
    """Columns renamed by a map; those it doesn't name by ``flat_name``. Two columns of one name are an error."""
    new = [(names or {}).get(c, flat_name(c)) for c in df.columns]
    if len(set(new)) < len(new):
        raise ValueError(f"columns would share a name: {sorted(n for n in set(new) if new.count(n) > 1)}")
    return df.toDF(*new)


def features_of(df: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    """The columns whose type, or an array's element type, is one of ``kinds`` (double, bigint, string ...)."""
    return df.select(*[F.col(f"`{c}`") for c, t in df.dtypes if t.removeprefix("array<").removesuffix(">") in kinds])


def v16_to_v20(frames: DataFrame, task: str | None = None, task_column: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(frames with task_index, tasks): one task for all, or one by column, numbered by first appearance."""
    if (task is None) == (task_column is None):
        raise ValueError("give a task or a task column")
    named = frames.withColumn("task", F.lit(task)) if task is not None else frames.withColumn("task", F.regexp_replace(F.regexp_replace(task_column, r"^tf\.Tensor\(b'", ""), r"', shape=\(\), dtype=string\)$", ""))
    tasks = meta.task_dictionary(named, "task", ["episode_index", "frame_index"])
    return meta.with_task_index(named, tasks, "task").drop("task"), tasks


def detailed(frames: DataFrame, columns: dict[str, int]) -> DataFrame:
    """Frames with vectors of one dimension as scalars, the others as float arrays of a checked width."""
    out = {}
    for c, width in columns.items():
        v = F.when(F.size(c) == width, F.transform(c, lambda x: x.cast("float"))).otherwise(F.raise_error(F.lit(f"{c} has another width than {width}")).cast("array<float>"))
        out[c] = F.get(v, F.lit(0)) if width == 1 else v
    return frames.withColumns(out)


def contract(groups: dict[str, dict[str, str]]):
    """Flat dotted columns of nested groups: {"state": {"eef_xyz": ...}} -> `state.eef_xyz`."""
    return [F.col(f"{g}.{c}").alias(f"{g}.{c}") for g, cs in groups.items() for c in cs]


def video_segments(episodes: DataFrame, fps: float, camera: str = "camera") -> DataFrame:
    """episodes (packed for each camera) with from_timestamp and to_timestamp in their file."""
    return trajectory.video_offsets(episodes.withColumn("__s", F.col("length") / F.lit(float(fps))), [camera, "ordinal"], "episode_index", "__s").drop("__s")


def segment_checks(segments: DataFrame, tolerance: float) -> DataFrame:
    """segments and ``ok``: a path without '..' and a measured duration as planned."""
    return segments.withColumn("ok", ~F.col("path").contains("..") & (F.abs(F.col("duration") - (F.col("to_timestamp") - F.col("from_timestamp"))) <= tolerance))
