"""Publishing what one job wrote: each year's (or variable's) files take the place of its earlier ones, others stay."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


class Store:
    """A folder's file system, through Hadoop: names are changed here, rows never pass."""

    def __init__(self, spark: SparkSession, folder: str):
        self._spark, self._path = spark, spark._jvm.org.apache.hadoop.fs.Path
        self.fs = self._path(folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self.fs.exists(self._path(path))

    def names(self, folder: str) -> list[str]:
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self._path(folder))) if self.exists(folder) else []

    def size(self, path: str) -> int:
        return self.fs.getFileStatus(self._path(path)).getLen()

    def delete(self, path: str) -> None:
        self.fs.delete(self._path(path), True)

    def rename(self, old: str, new: str) -> None:
        self.fs.mkdirs(self._path(new).getParent())
        if not self.fs.rename(self._path(old), self._path(new)):
            raise OSError(f"{old} can't be renamed to {new}")

    def write(self, path: str, text: str) -> None:
        out = self.fs.create(self._path(path), True)
        out.write(text.encode())
        out.close()

    def joined(self, parts: list[str], to: str) -> bool:
        """Makes one file of parts, the first of which is small, by the file system itself; False if it can't.

        HDFS moves blocks, a local file system copies. The length is checked.
        """
        local = "LocalFileSystem" in self.fs.getClass().getName()
        fs = self.fs.getRawFileSystem() if local else self.fs
        if not fs.hasPathCapability(self._path(to).getParent(), "fs.capability.paths.concat"):
            return False
        whole = sum(map(self.size, parts))
        first, rest = (to, parts) if local else (parts[0], parts[1:])  # the local one begins a new file
        if rest:
            array = self._spark.sparkContext._gateway.new_array(self._path, len(rest))
            for k, p in enumerate(rest):
                array[k] = self._path(p)
            fs.concat(self._path(first), array)
        if not local:
            self.rename(parts[0], to)
        if self.size(to) != whole:
            raise OSError(f"{to} has {self.size(to)} bytes, its parts {whole}")
        return True

    def replace(self, new: str | None, at: str) -> None:
        """What is at a path goes, new takes its place; until new is there, the old one is only moved aside."""
        aside = f"{at.rpartition('/')[0]}/_old-{uuid.uuid4().hex}"
        if old := self.exists(at):
            self.rename(at, aside)
        if new is not None:
            try:
                self.rename(new, at)
            except Exception:
                if old:
                    self.rename(aside, at)
                raise
        if old:
            self.delete(aside)


def write_by_year(rows: DataFrame, folder: str, fmt: str = "parquet", years: range | None = None, before=None) -> list[int]:
    """rows written once, then folder/year=... of each year replaced; gives the years.

    Years that the rows lack but `years` has become absent; all others stay as they are. before() is called between
    writing and publishing; where it raises, nothing is published.
    """
    store, stage = _written(rows, folder, fmt, "year")
    try:
        if before:
            before()
        there = {int(n.removeprefix("year=")): f"{stage}/{n}" for n in store.names(stage) if n.startswith("year=") and n[5:].lstrip("-").isdigit()}
        for year in sorted({*there, *(years or ())}):
            store.replace(there.get(year), f"{folder}/year={year}")
    finally:
        store.delete(stage)
    return sorted(there)


def write_named_files(rows: DataFrame, folder: str, names: dict, one_file: bool = True, before=None, column: str = "year") -> dict:
    """rows written once as CSV, then folder/<name> of each of the column's values replaced: one file with one header, made of the tasks' parts.

    names has a file name for each value; one without rows becomes a header alone. Where the file system can't join files, or
    one_file is False, the name is a folder of part files, each with a header. Gives what each became, `file` or `folder`.
    """
    store, stage = _written(rows, folder, "csv", column, not one_file)
    columns = ",".join(c if all(x not in c for x in ',"\n\r') else '"' + c.replace('"', '\\"') + '"' for c in rows.columns if c != column) + "\n"
    out = {}
    try:
        if before:
            before()
        for value, name in names.items():
            own = f"{stage}/{column}={value}"
            parts = [f"{own}/{n}" for n in store.names(own) if n.startswith("part-")]
            made = f"{own}/joined" if one_file else None
            if one_file or not parts:
                store.write(f"{own}/header", columns)
            if one_file and store.joined([f"{own}/header", *parts], made):
                out[value] = "file"
            else:
                made, out[value] = own, "folder"
                if one_file or not parts:
                    store.rename(f"{own}/header", f"{own}/part-00000-header.csv")
            store.replace(made, f"{folder}/{name}")
    finally:
        store.delete(stage)
    return out


def _written(rows: DataFrame, folder: str, fmt: str, column: str, header: bool = True) -> tuple[Store, str]:
    folder = folder.rstrip("/")
    stage = f"{folder}/_writing-{uuid.uuid4().hex}"
    store = Store(rows.sparkSession, folder)
    writer = rows.write.partitionBy(column)
    try:
        (writer.option("header", header).csv if fmt == "csv" else writer.json if fmt == "json" else writer.parquet)(stage)
    except Exception:
        store.delete(stage)
        raise
    return store, stage
