"""Mutable tables over plain parquet folders.

Rows live in slices, and each publish writes only the slices it changes, into a
fresh ``version=N`` folder. A small JSON file names the live version of every
slice and the last batch applied per application; renaming it into place is the
commit. A batch that is delivered again finds its number there and is skipped.
One writer at a time per table.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from parcelflow.operators.merge import TRACE, Merge, WrittenMerge, dealt_by_some

SLICE = "slice"
# Row ids are digests in hex, of which snappy saves nothing and this half.
COMPRESSION = "zstd"


def key_slices(count: int, *keys: str) -> Column:
    """Slice number of a row by the hash of its keys."""
    return F.pmod(F.xxhash64(*keys), F.lit(count)).cast("string")


@dataclass(frozen=True)
class _State:
    version: int
    slices: dict[str, int]
    applied: dict[str, int]


class SnapshotTable:
    """``slice_by`` derives the slice of a row from its merge keys (see
    ``key_slices``); without it, every append makes a slice of its own."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: StructType,
        slice_by: Column | None = None,
    ):
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = schema
        self.slice_by = slice_by

    # -- reading -----------------------------------------------------------

    def read(self, slices: Iterable[str] | None = None, with_slice: bool = False) -> DataFrame:
        """The live rows, or those of the named slices."""
        live = self._state().slices
        chosen = live if slices is None else {s: live[s] for s in slices if s in live}
        typed = StructType([*self.schema.fields, StructField(SLICE, StringType())])
        schema = typed if with_slice else self.schema
        if not chosen:
            return self.spark.createDataFrame([], schema)
        paths = [f"{self.path}/version={v}/{SLICE}={s}" for s, v in sorted(chosen.items())]
        rows = self.spark.read.schema(typed).option("basePath", self.path).parquet(*paths)
        return rows.select(*schema.names)

    def stream_path(self) -> str:
        """Where a file stream finds the rows of a table that is only appended to: each
        batch adds files and none is ever replaced."""
        return f"{self.path}/version=*/{SLICE}=*"

    def slices(self) -> list[str]:
        return sorted(self._state().slices)

    def applied(self, app: str) -> int | None:
        """Number of the last batch that the application published here."""
        return self._state().applied.get(app)

    # -- writing -----------------------------------------------------------

    def append(self, rows: DataFrame, app: str, batch: int) -> bool:
        """Add rows as the slice of this batch. False if it was applied before."""
        if self.slice_by is not None:
            raise ValueError("a table sliced by key is loaded with replace()")
        state = self._state()
        if self._seen(state, app, batch):
            return False
        name = self.batch_slice(app, batch)
        version = state.version + 1
        rows.select(*self.schema.names).write.mode("overwrite").parquet(
            f"{self.path}/version={version}/{SLICE}={name}", compression=COMPRESSION
        )
        self._commit(version, state.slices | {name: version}, state.applied | {app: batch})
        return True

    @staticmethod
    def batch_slice(app: str, batch: int) -> str:
        if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9_.-]*", app):
            raise ValueError(f"not usable as an application name: {app!r}")
        return f"{app}-{batch}"

    def replace(self, rows: DataFrame) -> None:
        """Make ``rows`` the whole table."""
        key = F.lit("all") if self.slice_by is None else self.slice_by
        state = self._state()
        version = state.version + 1
        written = self._write(rows.withColumn(SLICE, key), version)
        self._commit(version, dict.fromkeys(written, version), state.applied)

    def compact(self, slices: Iterable[str] | None = None) -> None:
        """Rewrite the named slices, or all, as one. Keeps the list of slices
        short on a table that gets a new one with every batch. The last batch of
        each application keeps its own: it may have to be finished from it."""
        if self.slice_by is not None:
            raise ValueError("a table sliced by key has a fixed number of slices")
        state = self._state()
        last = {f"{app}-{batch}" for app, batch in state.applied.items()}
        named = state.slices if slices is None else slices
        chosen = [s for s in named if s in state.slices and s not in last]
        if len(chosen) < 2:
            return
        version = state.version + 1
        name = f"compact-{version}"
        self.read(chosen).hint("rebalance").write.mode("overwrite").parquet(
            f"{self.path}/version={version}/{SLICE}={name}", compression=COMPRESSION
        )
        kept = {s: v for s, v in state.slices.items() if s not in chosen}
        self._commit(version, kept | {name: version}, state.applied)

    def delete_all(self) -> None:
        """Publish an empty table; the rows of older versions stay on disk."""
        state = self._state()
        self._commit(state.version + 1, {}, state.applied)

    def merge(
        self,
        build: Callable[[DataFrame, DataFrame], Merge],
        source: DataFrame,
        app: str,
        batch: int,
        slices: Iterable[str] | None = None,
        before: Callable[[Merge | WrittenMerge], None] | None = None,
    ) -> bool:
        """Publish ``build(target, source)``, rewriting only the slices that hold
        a matching row. False if the batch was applied before.

        ``slices`` names them when the caller knows them. ``before`` is called
        with the merge ahead of the publish, while the old values still stand:
        if the job dies in between, the batch comes again and sees the same. By
        then the new files lie there, with a trace of the old values that it reads.
        """
        state = self._state()
        if self._seen(state, app, batch):
            return False
        # Read for the slices and for the publish.
        again = slices is None and len(state.slices) > 1
        if again:
            source = source.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            with dealt_by_some(self.spark):
                if slices is None:
                    slices = self._touched(build(self.read(with_slice=True), source), state)
                slices = [s for s in slices if s in state.slices]
                merged = build(self.read(slices, with_slice=True), source)
                version, written = state.version + 1, []
                if slices:
                    rows = merged.rows() if before is None else merged.traced()
                    written = self._write(rows, version, slices)
            if before is not None:
                before(WrittenMerge(merged, self._read_traced(merged, version, written)) if written else merged)
            self._publish(written, state, app, batch)
        finally:
            if again:
                source.unpersist()
        return True

    def update(
        self,
        set_: Mapping[str, Column],
        where: Column,
        app: str,
        batch: int,
        slices: Iterable[str] | None = None,
    ) -> bool:
        """Publish new values for the rows that meet a condition: one pass over
        the slices, without a join. False if the batch was applied before."""
        state = self._state()
        if self._seen(state, app, batch):
            return False
        rows = self.read(slices, with_slice=True)
        changed = {c: F.when(where, v).otherwise(F.col(c)) for c, v in set_.items()}
        written = self._write(rows.withColumns(changed), state.version + 1, gather=False)
        self._publish(written, state, app, batch)
        return True

    def _publish(self, written: list[str], state: _State, app: str, batch: int) -> None:
        version = state.version + 1
        self._commit(
            version, state.slices | dict.fromkeys(written, version), state.applied | {app: batch}
        )

    def _read_traced(self, merge: Merge, version: int, written: list[str]) -> DataFrame:
        """The rows of a merge that are written and not published yet."""
        trace = merge.traced().schema[TRACE]
        schema = StructType([*self.schema.fields, StructField(SLICE, StringType()), trace])
        where = f"{self.path}/version={version}"
        paths = [f"{where}/{SLICE}={s}" for s in sorted(written)]
        return self.spark.read.schema(schema).option("basePath", where).parquet(*paths)

    def _touched(self, merge: Merge, state: _State) -> list[str]:
        """Slices with a row that the merge matches. At most one name per slice
        comes to the driver."""
        if len(state.slices) < 2:
            return list(state.slices)
        keys = merge.source_keys
        if self.slice_by is not None:
            found = keys.select(self.slice_by.alias(SLICE))
        else:
            target = merge.target.select(SLICE, *merge.on)
            found = target.join(keys, list(merge.on), "left_semi")
        names = [r[SLICE] for r in found.select(SLICE).distinct().collect()]
        return [n for n in names if n in state.slices]

    def _write(
        self, rows: DataFrame, version: int, slices: list[str] | None = None, gather: bool = True
    ) -> list[str]:
        """Write rows under their slices, which the caller may know. ``gather`` brings the rows
        of a slice together first, a large slice into several tasks."""
        where = f"{self.path}/version={version}"
        rows = rows.select(*self.schema.names, SLICE, *(c for c in rows.columns if c == TRACE))
        if slices is not None and len(slices) == 1:
            # Nothing to gather, and nothing to sort by slice.
            alone = rows.drop(SLICE).write.mode("overwrite")
            alone.parquet(f"{where}/{SLICE}={slices[0]}", compression=COMPRESSION)
            return slices
        if gather:
            rows = rows.hint("rebalance", F.col(SLICE))
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
        writer.partitionBy(SLICE).parquet(where, compression=COMPRESSION)
        names = [n for n in self._names(where) if n.startswith(f"{SLICE}=")]
        return [n.split("=", 1)[1] for n in names]

    # -- the commit file ---------------------------------------------------

    @staticmethod
    def _seen(state: _State, app: str, batch: int) -> bool:
        return batch <= state.applied.get(app, -1)

    def _hadoop(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _names(self, path: str) -> list[str]:
        fs, p = self._hadoop(path)
        return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []

    def _state(self) -> _State:
        commits = [n for n in self._names(f"{self.path}/_commits") if re.fullmatch(r"\d+\.json", n)]
        if not commits:
            return _State(0, {}, {})
        last = max(commits)
        fs, p = self._hadoop(f"{self.path}/_commits/{last}")
        stream = fs.open(p)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        content = json.loads(text)
        return _State(int(last.split(".")[0]), content["slices"], content["applied"])

    def _commit(self, version: int, slices: dict[str, int], applied: dict[str, int]) -> None:
        content = json.dumps({"slices": slices, "applied": applied}, sort_keys=True)
        fs, draft = self._hadoop(f"{self.path}/_commits/.{version:012d}.draft")
        out = fs.create(draft, True)
        try:
            out.write(bytearray(content, "utf-8"))
        finally:
            out.close()
        _, final = self._hadoop(f"{self.path}/_commits/{version:012d}.json")
        if fs.exists(final) or not fs.rename(draft, final):
            raise RuntimeError(f"another writer has published version {version} of {self.path}")
