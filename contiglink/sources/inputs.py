"""Checks of an analysis' inputs before any job, on the file system that each path names."""

from __future__ import annotations

from pyspark.sql import SparkSession


class InputError(ValueError):
    """Every input that is missing or empty, one a line."""


def sample_of(path: str) -> str:
    """A sample's name: its FASTA file's, up to the last `.fasta`."""
    return path.rstrip("/").rsplit("/", 1)[-1].rsplit(".fasta", 1)[0]


def found_files(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Files and sizes behind a path: a file, the visible files of a folder, or what a glob matches of both."""
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    place = hadoop.Path(path)
    store = place.getFileSystem(conf)
    out, todo = [], list(store.globStatus(place) or [])
    while todo:
        status = todo.pop()
        if not status.isDirectory():
            out.append((status.getPath().toString(), status.getLen()))
            continue
        todo += [s for s in store.listStatus(status.getPath()) if not s.getPath().getName().startswith(("_", "."))]
    return sorted(out)


def resolve(spark: SparkSession, paths: dict[str, str | list[str] | None], required: dict[str, str] | None = None) -> dict[str, list[str]]:
    """The files of each named input. Raises one InputError that names all that is wrong.

    paths: name -> a path, a glob or several. required: name -> what to call it, for inputs that must be given.
    Missing are inputs without a path, paths and globs that match nothing, and inputs all of whose files are empty.
    """
    wrong, out = [], {}
    for name, title in (required or {}).items():
        if not paths.get(name):
            wrong.append(f"{title} ({name}): no path is given")
    for name, given in paths.items():
        if not given:
            continue
        found, size = [], 0
        for path in [given] if isinstance(given, str) else given:
            try:
                files = found_files(spark, path)
            except Exception as e:  # an unknown or unreachable file system
                wrong.append(f"{name}: {path}: {str(e).splitlines()[0]}")
                continue
            if not files:
                wrong.append(f"{name}: {path} not found")
            found += [f for f, _ in files]
            size += sum(n for _, n in files)
        if found and not size:
            wrong.append(f"{name}: {given} is empty")
        out[name] = found
    if wrong:
        raise InputError("\n".join(wrong))
    return out
