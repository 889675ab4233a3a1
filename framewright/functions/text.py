"""Names, paths, dates and JSON of episode metadata."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_nonempty(*texts: Column) -> Column:
    """The first text that isn't empty; '' if all are, and NULL only if all are NULL."""
    return F.coalesce(*[F.nullif(t, F.lit("")) for t in texts], *texts)


def task_of_filename(name: Column, suffixes: tuple[str, ...] = ("_demo.hdf5",)) -> Column:
    """SCENE_words_of_task_demo.hdf5 -> words of task."""
    stem = name
    for s in suffixes:
        stem = F.regexp_replace(stem, s.replace(".", r"\.") + "$", "")
    return F.translate(F.regexp_replace(stem, r"^(?:[A-Z][A-Z0-9]*_)+(?=[a-z])", ""), "_", " ")


def strip_episode(name: Column) -> Column:
    """task_name_ep12 -> task name"""
    return F.translate(F.regexp_replace(name, r"_ep\d+$", ""), "_", " ")


def policy_letter(folder: Column) -> Column:
    return F.regexp_extract(folder, r"^([A-Z])_(.+)$", 1)


def policy_name(folder: Column) -> Column:
    return F.regexp_extract(folder, r"^([A-Z])_(.+)$", 2)


def date_parts(name: Column) -> Column:
    """MM-DD-YYYY in a name -> YYYY_MM_DD."""
    return F.regexp_replace(name, r"(\d{2})-(\d{2})-(\d{4})", "$3_$1_$2")


def is_version(text: Column) -> Column:
    return text.rlike(r"^\d+\.\d+\.\d+$")


def url_host(url: Column) -> Column:
    return F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)


def url_segment(url: Column, n: int) -> Column:
    """The n-th path segment, from 1; '' beyond the last."""
    path = F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*/?([^?#]*)", 1)
    return F.coalesce(F.get(F.split(path, "/"), F.lit(n - 1)), F.lit(""))


def path_tail(path: Column, n: int) -> Column:
    """The last n components joined by /; the whole path if it has fewer."""
    parts = F.split(path, "/")
    return F.array_join(F.when(F.size(parts) > n, F.slice(parts, -n, n)).otherwise(parts), "/")


def robot_slug(name: Column) -> Column:
    return F.lower(F.translate(name, " -", "__"))


def cut_at_nul(text: Column) -> Column:
    return F.substring_index(text, "\0", 1)


def codepoints_to_text(codes: Column) -> Column:
    return cut_at_nul(F.array_join(F.transform(codes, lambda c: F.chr(c)), ""))


def unwrap_tensor_text(text: Column) -> Column:
    """tf.Tensor(b'words', shape=(), dtype=string) -> words"""
    return F.regexp_replace(F.regexp_replace(text, r"^tf\.Tensor\(b'", ""), r"', shape=\(\), dtype=string\)$", "")


def iso_utc(seconds: Column) -> Column:
    """In a session with time zone UTC."""
    return F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def chunk_path(kind: str, chunk: Column, file: Column, extension: str = "parquet") -> Column:
    return F.format_string(f"{kind}/chunk-%03d/file-%03d.{extension}", chunk, file)


def episode_path(chunk: Column, episode: Column) -> Column:
    return F.format_string("data/chunk-%03d/episode_%06d.parquet", chunk, episode)


def flat_name(key: str) -> str:
    """observation.images.top -> top; what is left after two dotted parts, else the last."""
    parts = key.split(".")
    return "_".join(parts[2:]) or parts[-1]
