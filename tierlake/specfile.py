"""A source given by a file. The JSON form of ``LakeSpec``, checked before use.

A file names the fields of the spec; ``base`` starts from a spec by name and changes the
fields given. What cannot work is refused at once, with every fault named: unknown or
missing fields, wrong types, scores, place or ranked score outside the kept columns, equal
output names, a year column among the data columns, dialects that cannot be told apart.

    {"base": "exam", "name": "exam_2030", "file_stem": "DADOS_2030"}
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import MISSING, asdict, fields, replace

from pyspark.sql import SparkSession

from tierlake.sources.fs import read_small_text
from tierlake.spec import EXAM_SPEC, CsvDialect, LakeSpec

BASES: dict[str, LakeSpec] = {"exam": EXAM_SPEC}
_TUPLES = {f.name for f in fields(LakeSpec) if str(f.type).startswith("tuple")}
_KINDS = {"fill_value": (int, float), "digits": (int,)}


class SpecError(ValueError):
    """A spec file that cannot be used; ``faults`` lists why."""

    def __init__(self, faults: list[str]):
        super().__init__("; ".join(faults))
        self.faults = faults


def to_json(spec: LakeSpec) -> str:
    return json.dumps(asdict(spec), indent=2, ensure_ascii=False)


def _typed(kind, body: Mapping, where: str, faults: list[str]) -> dict:
    known = {f.name: f for f in fields(kind)}
    out = {}
    for name, value in body.items():
        if name not in known:
            faults.append(f"{where}{name}: no such field")
        elif name == "dialect":
            if isinstance(value, Mapping):
                out[name] = _typed(CsvDialect, value, "dialect.", faults)
            else:
                faults.append("dialect: must be an object")
        elif name in _TUPLES:
            if isinstance(value, list) and all(isinstance(v, str) and v for v in value):
                out[name] = tuple(value)
            else:
                faults.append(f"{where}{name}: must be a list of names")
        elif name == "multi_line":
            if not isinstance(value, bool):
                faults.append(f"{where}{name}: must be true or false")
            out[name] = value
        elif name in _KINDS:
            if isinstance(value, bool) or not isinstance(value, _KINDS[name]):
                faults.append(f"{where}{name}: must be a number")
            out[name] = value
        elif isinstance(value, str):
            out[name] = value
        else:
            faults.append(f"{where}{name}: must be a text")
    return out


def _faults_of(spec: LakeSpec) -> list[str]:
    out = []
    kept = set(spec.keep)
    for name in ("name", "place", "rank_score", "year_col", "file_stem", "mean_table", "profile_table", "rank_table"):
        if not getattr(spec, name):
            out.append(f"{name}: must not be empty")
    if "/" in spec.name:
        out.append("name: must not hold a slash, it names folders")
    for name in ("keep", "scores", "profile", "file_exts"):
        values = getattr(spec, name)
        if not values:
            out.append(f"{name}: must not be empty")
        if len({v.lower() for v in values} if name != "file_exts" else set(values)) != len(values):
            out.append(f"{name}: holds a name twice")
    for name, values in (("scores", spec.scores), ("profile", spec.profile), ("place", (spec.place,)), ("rank_score", (spec.rank_score,))):
        if lost := [v for v in values if v and v not in kept]:
            out.append(f"{name}: {lost} not in keep")
    if spec.rank_score and spec.rank_score not in spec.scores:
        out.append("rank_score: must be one of scores")
    if spec.year_col in kept:
        out.append("year_col: is a kept column, too")
    tables = [spec.mean_table, spec.profile_table, spec.rank_table]
    if len(set(tables)) != 3:
        out.append("mean_table, profile_table, rank_table: must differ")
    means = [spec.mean_name(s) for s in spec.scores]
    if len({m.lower() for m in means}) != len(means) or {m.lower() for m in means} & {spec.place.lower(), spec.year_col.lower()}:
        out.append("score_prefix, mean_prefix: output names are not distinct")
    if spec.count_name in (*spec.profile, spec.year_col):
        out.append("count_name: is a key of its table")
    if spec.rank_count_name in (spec.place, spec.year_col, spec.mean_name(spec.rank_score)):
        out.append("rank_count_name: is another column of its table")
    if not 0 <= spec.digits <= 15:
        out.append("digits: must be 0 to 15")
    d = spec.dialect
    if len(d.sep) < 1 or len(d.quote) > 1 or len(d.escape) > 1 or d.sep in (d.quote, d.escape, "\n", "\r"):
        out.append("dialect: sep, quote and escape cannot be told apart")
    try:
        "".encode(d.encoding)
    except LookupError:
        out.append(f"dialect.encoding: {d.encoding!r} is unknown")
    return out


def from_json(text: str) -> LakeSpec:
    """The spec of a file's text; raises ``SpecError`` with all its faults."""
    try:
        body = json.loads(text)
    except ValueError as e:
        raise SpecError([f"no JSON: {e}"]) from None
    if not isinstance(body, dict):
        raise SpecError(["must be an object"])
    body, faults = dict(body), []
    base = body.pop("base", None)
    if base is not None and base not in BASES:
        faults.append(f"base: {base!r} is not one of {sorted(BASES)}")
    given = _typed(LakeSpec, body, "", faults)
    start = BASES.get(base)
    if start is None:
        required = [f.name for f in fields(LakeSpec) if f.default is MISSING and f.default_factory is MISSING]
        faults += [f"{n}: missing" for n in required if n not in body]
    if faults:
        raise SpecError(faults)
    if "dialect" in given:
        given["dialect"] = replace(start.dialect if start else CsvDialect(), **given["dialect"])
    spec = replace(start, **given) if start else LakeSpec(**given)
    if faults := _faults_of(spec):
        raise SpecError(faults)
    return spec


def read_spec(spark: SparkSession, path: str) -> LakeSpec:
    return from_json(read_small_text(spark, path))


__all__ = ["SpecError", "from_json", "read_spec", "to_json"]
