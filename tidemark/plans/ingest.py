"""Routing of every table of a specification to its flow, batch or streaming."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.change import DELETED
from tidemark.plans.meta import INGESTION_TYPES, TableMeta, check_metadata
from tidemark.plans.spec import PipelineSpec, TableSpec
from tidemark.sources.files import Landed, read_batch, read_delete_stream, read_stream
from tidemark.streaming.apply import AppendTarget, MergeTarget, SnapshotTarget
from tidemark.streaming.read import append_stream, apply_stream, finish

_REGISTRY: dict[str, object] = {}


def register_transform(name: str, fn) -> None:
    """Register ``fn(df) -> df`` under a name a table's ``transform`` option can use."""
    if name in _REGISTRY and _REGISTRY[name] is not fn:
        raise ValueError(f"{name} is already registered")
    _REGISTRY[name] = fn


@dataclass(frozen=True)
class Flow:
    """What a table of the specification comes down to."""

    table: str
    destination: str
    kind: str  # upsert, snapshot or append
    keys: list[str]
    sequence: str | None
    scd_type: int
    with_deletes: bool
    cluster_by: list[str] | None
    options: dict[str, str]


def route(spec: TableSpec, meta: TableMeta) -> Flow:
    """Overrides beat metadata; an unknown type counts as cdc; APPEND_ONLY wins over the type."""
    kind = meta.ingestion_type if meta.ingestion_type in INGESTION_TYPES else "cdc"
    if spec.scd_type == "APPEND_ONLY":
        kind = "append"
    flow = {"snapshot": "snapshot", "append": "append"}.get(kind, "upsert")
    keys = spec.primary_keys or list(meta.primary_keys)
    seq = spec.sequence_by or meta.cursor_field
    if flow != "append" and not keys:
        raise ValueError(f"{spec.source_table}: no primary keys")
    if flow == "upsert" and not seq:
        raise ValueError(f"{spec.source_table}: no sequence column")
    return Flow(
        spec.source_table, spec.destination, flow, keys, seq, 2 if spec.scd_type == "SCD_TYPE_2" else 1,
        kind == "cdc_with_deletes", spec.cluster_by, spec.options,
    )


@dataclass
class Outcome:
    table: str
    destination: str
    kind: str
    error: str | None = None


class Ingestion:
    """A run of a specification into folders below ``root``: one target and checkpoint per table."""

    def __init__(self, spark: SparkSession, spec: dict, sources: dict[str, Landed], root: str):
        self.spark, self.sources, self.root = spark, sources, root.rstrip("/")
        self.spec = PipelineSpec.parse(spec)

    def _folder(self, flow: Flow) -> str:
        return f"{self.root}/tables/{flow.destination.replace('`', '').replace('.', '/')}"

    def _shape(self, df: DataFrame, flow: Flow) -> DataFrame:
        name = flow.options.get("transform")
        return _REGISTRY[name](df) if name else df

    def target(self, table: str):
        spec = self.spec.table(table)
        src = self.sources[table]
        flow = route(spec, src.meta)
        path = self._folder(flow)
        if flow.kind == "snapshot":
            return flow, SnapshotTarget(self.spark, path, flow.keys, flow.scd_type)
        schema = src.schema
        if schema is None or flow.options.get("transform"):
            schema = self._shape(read_batch(self.spark, src), flow).schema
        if flow.kind == "append":
            keys = flow.options.get("dedupe_keys")
            if keys:
                return flow, AppendTarget(self.spark, path, schema, [k.strip() for k in keys.split(",")], flow.sequence)
            return flow, None
        return flow, MergeTarget(self.spark, path, schema, flow.keys, flow.sequence, flow.scd_type, flow.cluster_by)

    def compact(self) -> None:
        """Compact every table that has a change log."""
        for spec in self.spec.tables:
            _, target = self.target(spec.source_table)
            if hasattr(target, "compact"):
                target.compact()

    def read(self, table: str) -> DataFrame:
        flow, target = self.target(table)
        return target.read() if target else self.spark.read.parquet(self._folder(flow))

    def _start(self, flow: Flow, target, version: int | None):
        src = self.sources[flow.table]
        files = flow.options.get("files_per_trigger")
        checkpoint = f"{self.root}/checkpoints/{flow.destination.replace('`', '')}"
        if flow.kind == "snapshot":
            target.apply(self._shape(read_batch(self.spark, src), flow), version)
            return None
        stream = self._shape(read_stream(self.spark, src, int(files) if files else None), flow)
        if flow.kind == "append":
            if target is None:
                return append_stream(stream, self._folder(flow), checkpoint)
            return apply_stream(stream, target, checkpoint, "append")
        stream = stream.withColumn(DELETED, F.lit(False))
        if flow.with_deletes and src.deletes:
            gone = read_delete_stream(self.spark, src, int(files) if files else None)
            # one query over both flows: one checkpoint holds both offsets
            stream = stream.unionByName(gone.withColumnRenamed("_deleted", DELETED), allowMissingColumns=True)
        return apply_stream(stream, target, checkpoint)

    def run(self, version: int | None = None) -> list[Outcome]:
        """Bring every table up to date. A table that fails does not stop the others.

        ``version`` numbers the snapshots of this run; by default each is the next one of its table.
        """
        started, outcomes = [], []
        for spec in self.spec.tables:
            name = spec.source_table
            try:
                src = self.sources[name]
                flow, target = self.target(name)
                meta = TableMeta(flow.keys, flow.sequence, src.meta.ingestion_type)
                if src.schema is not None and not flow.options.get("transform"):
                    problems = check_metadata(meta, src.schema)
                    if problems:
                        raise ValueError("; ".join(problems))
                started.append((flow, self._start(flow, target, version)))
            except Exception as e:  # noqa: BLE001 - reported per table
                outcomes.append(Outcome(name, spec.destination, "unknown", f"{type(e).__name__}: {e}"))
        for flow, query in started:
            error = None
            try:
                if query is not None:
                    finish(query)
            except Exception as e:  # noqa: BLE001 - reported per table
                error = f"{type(e).__name__}: {e}"
            outcomes.append(Outcome(flow.table, flow.destination, flow.kind, error))
        return outcomes


def ingest(spark: SparkSession, spec: dict, sources: dict[str, Landed], root: str, version: int | None = None) -> Ingestion:
    """Run the specification once; raises when a table failed, after all others finished."""
    run = Ingestion(spark, spec, sources, root)
    failed = [o for o in run.run(version) if o.error]
    if failed:
        raise RuntimeError("; ".join(f"{o.table}: {o.error}" for o in failed))
    return run
