"""A folder of state that knows its layout and the stream that owns it."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


def stream_job(spark: SparkSession) -> str | None:
    """Id of the streaming query whose batch is being processed; it is kept in the checkpoint."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId")


class StateFolder:
    """A folder of state that knows its layout and the stream that owns it.

    Subclasses set `spark`, `path` and `_checked`, and give `_layout` and `latest_version`.
    """

    # ------------------------------------------------------------ identity
    def _check_layout(self) -> None:
        """Refuse a table that was written with another layout (key, columns, ...)."""
        if self._checked:
            return
        mine = self._layout()
        path = f"{self.path}/layout.json"
        text = self._read_text(path)
        if text is None:
            self._write_text(path, json.dumps(mine))
        elif json.loads(text) != mine:
            raise ValueError(f"{self.path} was written with layout {text}, not {json.dumps(mine)}")
        self._checked = True

    def claim(self, batch_id: int, job: str | None = None) -> None:
        """Refuse a batch that cannot follow the table's versions.

        A table belongs to the stream (`job`, the query id kept in its
        checkpoint) that wrote it first; its batches may only repeat the newest
        version or go on from it. So a stream whose checkpoint was reset fails
        here instead of writing older versions over newer ones.
        """
        self._check_layout()
        newest = self.latest_version()
        if newest is not None and newest > batch_id:
            raise ValueError(f"{self.path} is at version {newest}, after batch {batch_id}: "
                             "its stream's checkpoint was reset or replaced; start with a new state folder")
        if job is None:
            return
        path = f"{self.path}/job.json"
        text = self._read_text(path)
        if text is None:
            self._write_text(path, json.dumps({"job": job}))
        elif json.loads(text)["job"] != job:
            raise ValueError(f"{self.path} belongs to another stream's checkpoint ({text})")

    # ------------------------------------------------------------ small files
    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def _read_text(self, path: str) -> str | None:
        fs, p = self._fs(path)
        if not fs.exists(p):
            return None
        stream = fs.open(p)
        try:
            scanner = self.spark.sparkContext._jvm.java.util.Scanner(stream, "UTF-8").useDelimiter("\\A")
            return scanner.next() if scanner.hasNext() else ""
        finally:
            stream.close()

    def _write_text(self, path: str, text: str) -> None:
        """Write a small file so that readers see all of it or none of it (temp file + rename)."""
        fs, p = self._fs(path)
        tmp = self._fs(f"{path}.{uuid.uuid4().hex}.tmp")[1]
        out = fs.create(tmp, True)
        try:
            out.write(bytearray(text.encode("utf-8")))
        finally:
            out.close()
        if fs.exists(p):          # a replayed batch rewrites its own version
            fs.delete(p, False)
        if not fs.rename(tmp, p):
            raise OSError(f"could not commit {path}")
