"""Spec files: round trip, every fault named, a run from the command line."""

import json

import pytest
from conftest import write_text

from tierlake.__main__ import main
from tierlake.spec import DOCUMENTS_SPEC, EXAM_SPEC, LINEITEM_SPEC
from tierlake.specfile import SpecError, from_json, to_json


@pytest.mark.parametrize("spec", [EXAM_SPEC, LINEITEM_SPEC, DOCUMENTS_SPEC])
def test_round_trip(spec):
    assert from_json(to_json(spec)) == spec


def test_base_keeps_what_is_not_given():
    spec = from_json(json.dumps({"base": "exam", "name": "x", "dialect": {"sep": "|"}}))
    assert spec == EXAM_SPEC.with_(name="x", dialect=spec.dialect) and spec.dialect.encoding == EXAM_SPEC.dialect.encoding


@pytest.mark.parametrize("body,said", [
    ("no json", "no JSON"),
    ("[1]", "object"),
    ({"base": "nobody"}, "nobody"),
    ({}, "keep: missing"),
    ({"base": "exam", "colour": "red"}, "colour: no such field"),
    ({"base": "exam", "scores": "NU_NOTA_CN"}, "scores: must be a list"),
    ({"base": "exam", "scores": ["NU_NOTA_XX", "NU_NOTA_REDACAO"]}, "NU_NOTA_XX"),
    ({"base": "exam", "rank_score": "TP_SEXO"}, "rank_score: must be one of scores"),
    ({"base": "exam", "place": "WHERE"}, "WHERE"),
    ({"base": "exam", "year_col": "TP_SEXO"}, "year_col"),
    ({"base": "exam", "digits": "two"}, "digits: must be a number"),
    ({"base": "exam", "digits": 99}, "digits: must be 0 to 15"),
    ({"base": "exam", "fill_value": True}, "fill_value"),
    ({"base": "exam", "keep": ["A", "a"]}, "keep: holds a name twice"),
    ({"base": "exam", "mean_table": "x", "rank_table": "x"}, "must differ"),
    ({"base": "exam", "name": "a/b"}, "slash"),
    ({"base": "exam", "count_name": "TP_SEXO"}, "count_name"),
    ({"base": "exam", "dialect": {"sep": ";", "quote": ";"}}, "told apart"),
    ({"base": "exam", "dialect": {"encoding": "klingon"}}, "klingon"),
    ({"base": "exam", "dialect": "csv"}, "dialect: must be an object"),
])
def test_faults_are_named(body, said):
    with pytest.raises(SpecError, match=said):
        from_json(body if isinstance(body, str) else json.dumps(body))


def test_all_faults_at_once():
    with pytest.raises(SpecError) as e:
        from_json(json.dumps({"base": "exam", "place": "P", "digits": 99, "profile": []}))
    assert len(e.value.faults) >= 3


def test_command_line_with_a_spec_file(spark, workdir):
    write_text(f"{workdir}/src.json", json.dumps({"base": "exam", "name": "mine", "file_stem": "F", "data_dir": "", "dialect": {"sep": "|"}}))
    write_text(f"{workdir}/raw/a_2020/F_2020.csv", "SG_UF_PROVA|NU_NOTA_CN|NU_NOTA_REDACAO\nSP|1|2\n")
    out = main(["--raw", f"{workdir}/raw", "--lake", f"{workdir}/lake", "--spec-file", f"{workdir}/src.json", "--versioned"])
    assert out["bronze"][0][1:] == (2020, "written", 1)
    from tierlake.plans import read_gold

    assert [r.MEDIA_CN for r in read_gold(spark, f"{workdir}/lake/gold/mine", EXAM_SPEC.mean_table).collect()] == [1.0]
