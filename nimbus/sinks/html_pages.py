"""K2 with a commit: one HTML file per row, published when the whole write is done.

A Spark data source writer. Each task stages its files in a folder of its own attempt;
the commit moves every successful attempt's folder to its place (one move per task, on the
driver) and then writes the success marker. A failed attempt's folder is never moved, an
aborted write removes its staging area, and a task that runs again stages anew, so no file
is published twice or in part. The directory must be a URI all executors reach.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

FORMAT = "nimbus_html_pages"
MARKER = "_SUCCESS"
#: The names of a part's pages, one a line: the manifest (a listing would pass over empty files).
NAMES = "names.txt"


def _filesystem(uri: str):
    from pyarrow import fs

    if ":/" not in uri:
        raise ValueError(f"{uri!r}: a URI is needed, as a plain path is every machine's own disk")
    return fs.FileSystem.from_uri(uri.replace("file:/", "file:///", 1) if uri.startswith("file:/") and not uri.startswith("file://") else uri)


@dataclass
class Staged(WriterCommitMessage):
    """What a finished task attempt left: its folder, none if it had no rows."""

    folder: str | None
    pages: int


class HtmlPagesWriter(DataSourceWriter):
    def __init__(self, options: dict[str, str]) -> None:
        self.directory, self.suffix = options["directory"].rstrip("/"), options.get("suffix", ".HTML")
        self.job = uuid.uuid4().hex  # one per write, the same in all its tasks

    def write(self, rows: Iterator) -> Staged:
        filesystem, base = _filesystem(self.directory)
        folder, names = f"{base}/_staging-{self.job}/{uuid.uuid4().hex}", []
        for ident, page in rows:
            if not names:
                filesystem.create_dir(folder, recursive=True)
            if not ident or "/" in ident or "\n" in ident:
                raise ValueError(f"{ident!r} can't name a file")
            with filesystem.open_output_stream(f"{folder}/{ident}{self.suffix}") as out:
                out.write(("" if page is None else page).encode())
            names.append(ident)
        if names:
            with filesystem.open_output_stream(f"{folder}/{NAMES}") as out:
                out.write("\n".join(names).encode())
        return Staged(folder.rsplit("/", 1)[1] if names else None, len(names))

    def commit(self, messages: list) -> None:
        filesystem, base = _filesystem(self.directory)
        staging = f"{base}/_staging-{self.job}"
        for message in messages:
            if message is not None and message.folder:
                filesystem.move(f"{staging}/{message.folder}", f"{base}/part-{message.folder}")
        self._clear(filesystem, staging)
        with filesystem.open_output_stream(f"{base}/{MARKER}") as out:
            out.write(b"")

    def abort(self, messages: list) -> None:
        filesystem, base = _filesystem(self.directory)
        self._clear(filesystem, f"{base}/_staging-{self.job}")

    @staticmethod
    def _clear(filesystem, folder: str) -> None:
        from pyarrow import fs

        if filesystem.get_file_info(folder).type == fs.FileType.Directory:
            filesystem.delete_dir(folder)


class HtmlPages(DataSource):
    """``df.write.format(FORMAT).option("directory", uri)`` of a frame (name, page)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema, overwrite: bool) -> HtmlPagesWriter:
        return HtmlPagesWriter(self.options)


def write_pages(df: DataFrame, directory: str, html: str = "html_report", name: str = "external_id", suffix: str = ".HTML") -> DataFrame:
    """One file ``{name}{suffix}`` per row, all of them or none; the frame ``published`` gives of the directory."""
    spark = df.sparkSession
    spark.dataSource.register(HtmlPages)
    rows = df.select(F.col(name).cast("string").alias("name"), F.col(html).cast("string").alias("page"))
    rows.write.format(FORMAT).mode("append").option("directory", directory).option("suffix", suffix).save()
    return published(spark, directory, name, suffix)


def published(spark, directory: str, name: str = "external_id", suffix: str = ".HTML") -> DataFrame:
    """(name, filename) of every published page, from the manifests of the parts."""
    lines = spark.read.text(f"{directory.rstrip('/')}/part-*/{NAMES}").select("value", F.col("_metadata.file_path").alias("file"))
    folder = F.left("file", F.length("file") - len(NAMES))
    return lines.select(F.col("value").alias(name), F.concat(folder, F.col("value"), F.lit(suffix)).alias("filename"))
