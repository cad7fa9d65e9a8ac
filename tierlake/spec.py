"""Declarative description of one yearly-survey lake.

A ``LakeSpec`` is the only place where a source's names live: which columns survive
into silver, which of them are scores, what the place and profile keys are, how the
raw text is spelled and where it sits. Every stage and operator takes the spec (or
plain column lists) as an argument, so a second source is a second instance.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field, replace


@dataclass(frozen=True)
class CsvDialect:
    """How the raw delimited text is written.

    ``multi_line`` stays off for sources whose records are single lines: a file can
    then be split across many tasks. Turn it on only for text with quoted newlines;
    each file is then read by one task, so write such files in bounded parts.
    """

    sep: str = ","
    encoding: str = "UTF-8"
    quote: str = '"'
    escape: str = "\\"
    multi_line: bool = False

    def read_options(self) -> dict[str, str]:
        return {
            "header": "true",
            "sep": self.sep,
            "encoding": self.encoding,
            "quote": self.quote,
            "escape": self.escape,
            "multiLine": str(self.multi_line).lower(),
            "mode": "PERMISSIVE",
            "inferSchema": "false",
        }

    def write_options(self) -> dict[str, str]:
        return {
            "header": "true",
            "sep": self.sep,
            "encoding": self.encoding,
            "quote": self.quote,
            "escape": self.escape,
            "ignoreLeadingWhiteSpace": "false",
            "ignoreTrailingWhiteSpace": "false",
        }


@dataclass(frozen=True)
class LakeSpec:
    """One source's names and layout: silver allow-list, scores, place, profile and
    rank columns, output names, year partition column, raw dialect and layout, zip
    member rule and gold table names."""

    name: str
    keep: tuple[str, ...]
    scores: tuple[str, ...]
    place: str
    profile: tuple[str, ...]
    rank_score: str
    score_prefix: str = ""
    mean_prefix: str = "mean_"
    count_name: str = "total"
    rank_count_name: str = "total"
    year_col: str = "year"
    fill_value: float = 0.0
    digits: int = 2
    dialect: CsvDialect = field(default_factory=CsvDialect)
    # Raw layout: <raw>/<anything>_<year>/<data_dir>/<file_stem>_<year><ext>
    data_dir: str = ""
    file_stem: str = "data"
    file_exts: tuple[str, ...] = (".csv",)
    # Zip members: every token must occur in the member name, plus the suffix.
    member_tokens: tuple[str, ...] = ()
    member_suffix: str = ".csv"
    mean_table: str = "means"
    profile_table: str = "profile"
    rank_table: str = "ranking"

    def mean_name(self, score: str) -> str:
        base = score[len(self.score_prefix):] if score.startswith(self.score_prefix) else score
        return self.mean_prefix + base

    def file_names(self, year: int) -> list[str]:
        return [f"{self.file_stem}_{year}{ext}" for ext in self.file_exts]

    def raw_files(self, folder: str, year: int) -> list[str]:
        """Candidate raw files of one year folder, in preference order."""
        base = folder.rstrip("/") + (f"/{self.data_dir}" if self.data_dir else "")
        return [f"{base}/{n}" for n in self.file_names(year)]

    def member_name(self, year: int) -> str:
        """A member name this spec's zip filter accepts (for writing archives)."""
        return "".join(self.member_tokens) + f"_{year}{self.member_suffix}"

    def with_(self, **changes) -> "LakeSpec":
        return replace(self, **changes)


YEAR_SUFFIX = re.compile(r"_(\d{4})$")


def year_from_name(name: str) -> int | None:
    """Year is the last ``_`` token of a folder or archive stem, when it has 4 digits."""
    stem = name.rstrip("/").rsplit("/", 1)[-1]
    for ext in (".zip", ".ZIP"):
        if stem.endswith(ext):
            stem = stem[: -len(ext)]
    m = YEAR_SUFFIX.search(stem)
    return int(m.group(1)) if m else None


# ---------------------------------------------------------------------------------
# Fixed values of the exam-survey source. They must equal the source's for the same
# files to be found and the same tables to come out: the silver column allow-list
# in silver order; the five score columns; the place column; the three profile
# columns; the essay score that is ranked; the score prefix and the mean prefix
# that replaces it; the two count names; the year partition name; the raw text
# dialect; the raw layout (data folder, file stem, extensions); the zip member
# rule; the three gold table names.
# ---------------------------------------------------------------------------------
YEAR_COL = "ano"

EXAM_SPEC = LakeSpec(
    name="exam",
    keep=(
        "NU_INSCRICAO",
        "TP_FAIXA_ETARIA",
        "TP_SEXO",
        "TP_ESTADO_CIVIL",
        "TP_COR_RACA",
        "TP_ESCOLA",
        "IN_TREINEIRO",
        "SG_UF_PROVA",
        "NU_NOTA_CN",
        "NU_NOTA_CH",
        "NU_NOTA_LC",
        "NU_NOTA_MT",
        "NU_NOTA_REDACAO",
    ),
    scores=("NU_NOTA_CN", "NU_NOTA_CH", "NU_NOTA_LC", "NU_NOTA_MT", "NU_NOTA_REDACAO"),
    place="SG_UF_PROVA",
    profile=("TP_FAIXA_ETARIA", "TP_SEXO", "TP_COR_RACA"),
    rank_score="NU_NOTA_REDACAO",
    score_prefix="NU_NOTA_",
    mean_prefix="MEDIA_",
    count_name="TOTAL_CANDIDATOS",
    rank_count_name="TOTAL_PARTICIPANTES",
    year_col=YEAR_COL,
    dialect=CsvDialect(sep=";", encoding="ISO-8859-1"),
    data_dir="DADOS",
    file_stem="MICRODADOS_ENEM",
    file_exts=(".csv", ".CSV"),
    member_tokens=("DADOS/", "RESULTADOS"),
    member_suffix=".csv",
    mean_table="media_notas_por_uf_ano",
    profile_table="distribuicao_perfil",
    rank_table="ranking_redacao_por_uf",
)


# The driver's lineitem table read as a survey laid out like the exam source (same
# dialect, folders and member rule): year = ship year, place = return flag, scores =
# the four measures, profile = flag, status and line number.
LINEITEM_SPEC = EXAM_SPEC.with_(
    name="lineitem",
    keep=(
        "l_orderkey",
        "l_linenumber",
        "l_returnflag",
        "l_linestatus",
        "l_quantity",
        "l_extendedprice",
        "l_discount",
        "l_tax",
    ),
    scores=("l_quantity", "l_extendedprice", "l_discount", "l_tax"),
    place="l_returnflag",
    profile=("l_returnflag", "l_linestatus", "l_linenumber"),
    rank_score="l_tax",
    score_prefix="l_",
    mean_prefix="media_",
    count_name="total",
    rank_count_name="total",
    file_stem="MICRODADOS_LINEITEM",
    mean_table="mean_by_year_place",
    profile_table="profile_counts",
    rank_table="rank_by_place",
)


# The driver's documents table as a yearly text source (used by the CSV and zip
# round trips). Texts hold newlines and quotes, so records span lines and quotes
# are doubled.
DOCUMENTS_SPEC = EXAM_SPEC.with_(
    name="documents",
    keep=("doc_id", "text", "lang", "source", "n_chars"),
    scores=("n_chars",),
    place="lang",
    profile=("lang", "source"),
    rank_score="n_chars",
    score_prefix="",
    mean_prefix="media_",
    count_name="total",
    rank_count_name="total",
    dialect=CsvDialect(sep=";", encoding="ISO-8859-1", escape='"', multi_line=True),
    file_stem="MICRODADOS_DOCS",
)
