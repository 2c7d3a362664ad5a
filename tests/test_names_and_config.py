import dataclasses

import pytest
from hypothesis import given
from hypothesis import strategies as st

from modelloom.config import ModelConfig
from modelloom.errors import ConfigError
from modelloom.plans import Project
from modelloom.sources import RelationName, Source, read_relation


@pytest.mark.parametrize("text, parts", [
    (' "a.b" . c ', ("a.b", "c")),
    ('x . "y z" . `w.w`', ("x", "y z", "w.w")),
    ('"select"', ("select",)),
    ('"say ""hi"""', ('say "hi"',)),
    ("`tick``ed`", ("tick`ed",)),
    ("my-shop.t", ("my-shop", "t")),
])
def test_parse(text, parts):
    assert RelationName.parse(text).parts == parts


@pytest.mark.parametrize("text", ["", "  ", "a.b.c.d", "a.b.c.d.e", "a..b", "a.", ".a", '"a"b', '""'])
def test_parse_rejects(text):
    with pytest.raises(ValueError):
        RelationName.parse(text)


@given(st.lists(st.text(min_size=1, max_size=8), min_size=1, max_size=3), st.sampled_from('"`'))
def test_sql_text_and_parse_are_inverse(parts, quote):
    name = RelationName(tuple(parts))
    assert RelationName.parse(name.sql(quote)) == name


def test_texts_and_relatives():
    name = RelationName(("shop", "core", "t"))
    assert name.sql() == "`shop`.`core`.`t`"
    assert name.sql('"') == '"shop"."core"."t"'
    assert name.dotted() == "shop.core.t"
    assert name.schema.parts == ("shop", "core")
    assert name.within_catalog().parts == ("core", "t")
    assert name.sibling("_2").parts == ("shop", "core", "t_2")
    assert RelationName(("t",)).schema is None
    with pytest.raises(dataclasses.FrozenInstanceError):
        name.parts = ()


def test_model_is_stored_under_alias_or_name():
    project = Project("core")
    project.sql_model("m", "select 1 as a")
    project.sql_model("n", "select 1 as a", alias="b")
    assert [project.relation(x).dotted() for x in "mn"] == ["core.m", "core.b"]
    other = Project("core", database="shop")
    other.sql_model("m", "select 1 as a")
    assert other.relation("m").dotted() == "shop.core.m"


def test_config_defaults_and_overrides():
    base = ModelConfig()
    assert (base.materialized, base.workers, base.cpus_per_worker, base.timeout_s) == ("table", None, 1, None)
    mine = ModelConfig(workers=7, timeout_s=0.5)
    assert mine.override({}) == mine == mine.override(None)
    changed = mine.override({"workers": " 9 ".strip(), "ram_per_worker": 3})
    assert (changed.workers, changed.ram_per_worker, changed.timeout_s) == (9, 3, 0.5)
    assert changed.override({"timeout_s": None, "workers": None}) == ModelConfig(ram_per_worker=3)


@pytest.mark.parametrize("settings", [
    {"worker": 3}, {"workers": "many"}, {"workers": 0}, {"timeout_s": -1}, {"materialized": "cube"},
])
def test_config_rejects(settings):
    with pytest.raises(ConfigError):
        ModelConfig().override(settings)


def test_source_needs_one_place():
    with pytest.raises(ConfigError):
        Source("g", "t")
    with pytest.raises(ConfigError):
        Source("g", "t", relation="a.b", path="/x")
    assert Source("g", "t", relation='"a"."b"').sql_name() == "`a`.`b`"
    assert Source("g", "t", path="/x/y").sql_name() == "parquet.`/x/y`"
    with pytest.raises(ConfigError):
        Source("g", "t", path="/x", format="csv", options={"header": "true"}).sql_name()


def test_read_with_reader_options(spark, tmp_path, rows):
    (tmp_path / "t.csv").write_text("a;b\n1;x\n2;y\n")
    source = Source("raw", "t", path=str(tmp_path), format="csv", schema="a int, b string",
                    options={"header": "true", "sep": ";"})
    assert rows(source.read(spark)) == [(1, "x"), (2, "y")]


def test_read_relation_by_three_parts(spark, schema):
    spark.range(3).write.saveAsTable(f"`{schema}`.plain")
    assert read_relation(spark, f'"spark_catalog"."{schema}"."plain"').count() == 3
