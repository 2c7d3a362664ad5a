"""Models that refer to each other, run in the order of their references.

A Python model is a function ``model(ctx, spark) -> DataFrame``; it only
describes the work, the write that stores it is what runs it. A SQL model is a
Spark SQL text with ``{{ ref('x') }}``, ``{{ source('g', 't') }}`` and
``{{ this }}`` in place of relation names; it may carry its settings in a
``{{ config(...) }}`` and comments in ``{# ... #}``.
"""

from __future__ import annotations

import ast
import logging
import re
import time
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from graphlib import CycleError, TopologicalSorter
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from modelloom.config import ModelConfig
from modelloom.errors import ConfigError, LoomError, ModelError, ModelTimeout, ResultError
from modelloom.functions import free_name
from modelloom.operators.checks import suite
from modelloom.operators.materialize import append_table, create_view, kind_of, recover, replace_table, time_limit
from modelloom.operators.parallel import parallel_map, worker_resources
from modelloom.sources import RelationName, Source, read_relation

log = logging.getLogger("modelloom")

_MARKER = re.compile(
    r"""\{\{\s*(?:(?P<this>this)
        |ref\(\s*(?P<q1>['"])(?P<ref>[^'"]+)(?P=q1)\s*\)
        |source\(\s*(?P<q2>['"])(?P<group>[^'"]+)(?P=q2)\s*,
                 \s*(?P<q3>['"])(?P<table>[^'"]+)(?P=q3)\s*\)
        )\s*\}\}""",
    re.VERBOSE,
)
_COMMENT = re.compile(r"\{#.*?#\}", re.DOTALL)
_CONFIG = re.compile(r"\{\{\s*config\((.*?)\)\s*\}\}", re.DOTALL)


def _settings(call: str) -> dict[str, Any]:
    """The settings in the brackets of a ``config(...)``: names with literal values, nothing else."""
    try:
        tree = ast.parse(f"config({call.strip()})", mode="eval").body
        if tree.args or any(k.arg is None for k in tree.keywords):
            raise ValueError("settings need names")
        return {k.arg: ast.literal_eval(k.value) for k in tree.keywords}
    except (SyntaxError, ValueError) as exc:
        raise ConfigError(f"config({call.strip()}) holds more than names with literal values: {exc}") from exc


@dataclass(frozen=True)
class Model:
    name: str
    body: Callable[[Context, SparkSession], DataFrame] | str
    config: ModelConfig
    refs: tuple[str, ...] = ()
    sources: tuple[tuple[str, str], ...] = ()
    alias: str | None = None
    tests: Mapping[str, Sequence[str]] = field(default_factory=dict)
    incremental_text: str | None = None


@dataclass(frozen=True)
class ModelRun:
    """What a run did to one model; views hold no rows of their own."""

    model: str
    materialized: str
    rows: int | None
    runtime_s: float


class Project:
    """A set of models that share a schema, defaults and declared sources."""

    def __init__(
        self,
        schema: str,
        *,
        database: str | None = None,
        defaults: ModelConfig | None = None,
        format: str = "parquet",
    ) -> None:
        self.schema = schema
        self.database = database
        self.defaults = defaults or ModelConfig()
        self.format = format
        self.models: dict[str, Model] = {}
        self.declared: dict[tuple[str, str], Source] = {}

    # --- declaring ----------------------------------------------------------

    def source(self, group: str, table: str, **where: Any) -> Source:
        source = Source(group, table, **where)
        self.declared[group, table] = source
        return source

    def model(
        self,
        name: str | None = None,
        *,
        refs: Iterable[str] = (),
        sources: Iterable[tuple[str, str]] = (),
        alias: str | None = None,
        tests: Mapping[str, Sequence[str]] | None = None,
        **settings: Any,
    ) -> Callable:
        """Decorator that registers a Python model with the relations it reads."""

        def register(body: Callable) -> Callable:
            self._add(Model(
                name or body.__name__, body, self.defaults.override(settings), tuple(refs),
                tuple(tuple(s) for s in sources), alias, dict(tests or {}),
            ))
            return body

        return register

    def sql_model(
        self,
        name: str,
        text: str,
        *,
        incremental_text: str | None = None,
        alias: str | None = None,
        tests: Mapping[str, Sequence[str]] | None = None,
        **settings: Any,
    ) -> None:
        """Register a SQL model; a view unless ``materialized`` says otherwise.

        ``incremental_text`` takes the place of ``text`` once the target of an
        incremental model exists.
        """
        text = _COMMENT.sub("", text)
        inside = {name: value for call in _CONFIG.findall(text) for name, value in _settings(call).items()}
        text = _CONFIG.sub("", text)
        both = text + (incremental_text or "")
        markers = list(_MARKER.finditer(both))
        if re.search(r"\{[{%]", _MARKER.sub("", both)):
            raise ConfigError(
                f"model `{name}` has a template expression other than ref, source, this, config"
            )
        self._add(Model(
            name, text, self.defaults.override({"materialized": "view", **inside, **settings}),
            tuple(dict.fromkeys(m["ref"] for m in markers if m["ref"])),
            tuple(dict.fromkeys((m["group"], m["table"]) for m in markers if m["group"])),
            alias, dict(tests or {}), incremental_text,
        ))

    def declare(self, document: Mapping[str, Any]) -> None:
        """Take sources, settings and tests from a properties document.

        The shape is that of the usual YAML files, already loaded: ``sources``
        with ``name``, ``schema``, ``database`` and ``tables``; ``models`` with
        ``name``, ``config`` and ``columns``, whose ``tests`` are names. Models
        must have been registered before.
        """
        for group in document.get("sources") or ():
            for table in group["tables"]:
                place = [group.get("database"), group.get("schema") or group["name"]]
                name = RelationName((
                    *filter(None, place), table.get("identifier") or table["name"]
                ))
                self.source(group["name"], table["name"], relation=name.sql())
        for entry in document.get("models") or ():
            model = self._known(entry["name"])
            tests = {
                c["name"]: c.get("tests") or c.get("data_tests") or []
                for c in entry.get("columns") or ()
            }
            self._add(replace(
                model, config=model.config.override(entry.get("config")),
                tests={**model.tests, **{c: names for c, names in tests.items() if names}},
            ))

    def _add(self, model: Model) -> None:
        if model.config.materialized == "view" and not isinstance(model.body, str):
            raise ConfigError(f"model `{model.name}` is Python code and cannot be stored as a view")
        self.models[model.name] = model

    def relation(self, name: str) -> RelationName:
        """Where a model is stored."""
        model = self._known(name)
        place = [self.database] if self.database else []
        return RelationName((*place, self.schema, model.alias or name))

    def _known(self, name: str) -> Model:
        try:
            return self.models[name]
        except KeyError:
            raise ConfigError(f"no model named `{name}`") from None

    def order(self) -> list[str]:
        """Model names, every model after the ones it refers to."""
        for model in self.models.values():
            for ref in model.refs:
                self._known(ref)
            for key in model.sources:
                if key not in self.declared:
                    raise ConfigError(f"model `{model.name}` reads undeclared source {'.'.join(key)}")
        try:
            return list(TopologicalSorter({m.name: m.refs for m in self.models.values()}).static_order())
        except CycleError as exc:
            raise ConfigError(f"models refer to each other in a circle: {exc.args[1]}") from exc

    # --- running ------------------------------------------------------------

    def run(
        self,
        spark: SparkSession,
        *,
        select: Iterable[str] | None = None,
        full_refresh: bool = False,
    ) -> list[ModelRun]:
        """Build all models, or the selected ones from what is already stored."""
        chosen = None if select is None else {self._known(n).name for n in select}
        return [
            self._run_model(spark, self.models[name], full_refresh)
            for name in self.order()
            if chosen is None or name in chosen
        ]

    def _run_model(self, spark: SparkSession, model: Model, full_refresh: bool) -> ModelRun:
        start = time.perf_counter()
        try:
            with time_limit(spark, model.config.timeout_s, model.name):  # of the body and the write
                rows = self._build(spark, model, full_refresh)
        except ModelTimeout as exc:
            raise ModelTimeout(model.name, exc.seconds) from exc
        except LoomError as exc:
            if isinstance(exc, ModelError):
                raise
            raise ModelError(model.name, exc) from exc
        except Exception as exc:
            raise ModelError(model.name, exc) from exc
        took = round(time.perf_counter() - start, 3)
        log.info("model %s: %s, %s rows, %.2f s", model.name, model.config.materialized, rows, took)
        return ModelRun(model.name, model.config.materialized, rows, took)

    def _build(self, spark: SparkSession, model: Model, full_refresh: bool) -> int | None:
        target = self.relation(model.name)
        stored = model.config.materialized
        recover(spark, target)
        grows = stored == "incremental" and not full_refresh and kind_of(spark, target) == "table"
        ctx = Context(self, model, spark, grows)
        if isinstance(model.body, str):
            text = model.incremental_text if grows and model.incremental_text else model.body
            query = _MARKER.sub(ctx.sql_name, text)
            if stored == "view":
                create_view(spark, target, query)
                return None
            df = spark.sql(query)
        else:
            df = model.body(ctx, spark)
            if not isinstance(df, DataFrame):
                raise ResultError(f"a model must return a Spark DataFrame, got {type(df).__name__}")
        write = append_table if grows else replace_table
        return write(df, target, format=self.format, partition_by=model.config.partition_by)

    def test(self, spark: SparkSession, *, select: Iterable[str] | None = None) -> DataFrame:
        """The declared tests of the stored models as (model, column, test, failures)."""
        names = self.models if select is None else select
        return suite({
            n: (read_relation(spark, self.relation(n)), self._known(n).tests)
            for n in names if self._known(n).tests
        })


class Context:
    """What a model gets to see of its project. All frames are lazy."""

    def __init__(self, project: Project, model: Model, spark: SparkSession, grows: bool) -> None:
        self._project = project
        self._model = model
        self._spark = spark
        self.is_incremental = grows
        self.config = model.config

    def ref(self, name: str) -> DataFrame:
        """The stored result of another model."""
        if name not in self._model.refs:
            raise ConfigError(f"`{name}` is not among the declared refs of `{self._model.name}`")
        return read_relation(self._spark, self._project.relation(name))

    def source(self, group: str, table: str) -> DataFrame:
        """A declared source."""
        if (group, table) not in self._model.sources:
            raise ConfigError(f"{group}.{table} is not among the declared sources of `{self._model.name}`")
        return self._project.declared[group, table].read(self._spark)

    @property
    def this(self) -> DataFrame:
        """The model's own table as it was before this run."""
        return read_relation(self._spark, self._project.relation(self._model.name))

    def parallel_map(self, df: DataFrame, fn: Callable, **how: Any) -> DataFrame:
        """:func:`parallel_map` with the model's workers, batch size and resources."""
        c = self.config
        how = {
            "workers": c.workers,
            "batch_size": c.batch_size,
            "resources": worker_resources(c.cpus_per_worker, c.ram_per_worker),
            **how,
        }
        return parallel_map(df, fn, **how)

    def sql_name(self, marker: re.Match) -> str:
        if marker["this"]:
            return self._project.relation(self._model.name).sql()
        if marker["ref"]:
            return self._project.relation(marker["ref"]).sql()
        return self._project.declared[marker["group"], marker["table"]].sql_name()


def only_new(
    df: DataFrame,
    this: DataFrame,
    *,
    newer_by: str,
    key: str | None = None,
    look_back: Column | None = None,
) -> DataFrame:
    """Rows of ``df`` an incremental table does not have yet.

    Without a ``key`` these are the rows newer than the newest stored one; rows
    that tie with it count as stored, and since a null order value cannot be
    told new from old, a ConfigError refuses it. With a ``key`` they are the rows
    not older than the newest one (less ``look_back``) or without an order
    value, unless their key is stored; null is a key like any other.
    """
    # one value by way of the driver, so that the bound is a literal which the
    # scan can use to skip row groups; an instant as its microseconds, others as text
    kind = this.schema[newer_by].dataType
    largest = F.max(newer_by)
    if isinstance(kind, TimestampType):
        newest = this.agg(F.unix_micros(largest)).first()[0]
        bound = F.timestamp_micros(F.lit(newest))
    else:
        newest = this.agg(largest.cast("string")).first()[0]
        bound = F.lit(newest).cast(kind)
    at = F.col(f"`{newer_by}`")
    if key is None:
        if look_back is not None:
            raise ConfigError("a look-back needs a key to tell stored rows from new ones")
        if not df.where(at.isNull()).isEmpty():
            raise ConfigError(f"rows without `{newer_by}` need a key to tell stored rows from new ones")
        return df if newest is None else df.where(at > bound)
    since = bound if look_back is None else bound - look_back
    recent = F.lit(True) if newest is None else at.isNull() | (at >= since)
    stored = free_name(df, "_stored")
    keys = this.where(recent).select(F.col(f"`{key}`").alias(stored))
    return df.where(recent).join(keys, F.col(f"`{key}`").eqNullSafe(F.col(stored)), "left_anti")


def report(spark: SparkSession, runs: Sequence[ModelRun]) -> DataFrame:
    """The runs as a frame of (model, materialized, rows, runtime_s)."""
    return spark.createDataFrame(
        [(r.model, r.materialized, r.rows, r.runtime_s) for r in runs],
        "model string, materialized string, rows bigint, runtime_s double",
    )
