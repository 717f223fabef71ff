"""Operators that return their input's columns, with clashing extra columns."""

import re
from pathlib import Path

import pytest

from affinia.llm import language, mixing, simhash, suffixes

FOLDER = Path(simhash.__file__).parent
OPERATORS = {
    "simhash": (simhash.keep_one_each, "simhash components"),
    "suffixes": (suffixes.strip_repeats, "suffixes"),
    "language": (language.keep_identified, "language"),
    "mixing": (mixing.sample, "mixing"),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_internal_names_as_extra_columns(spark, name):
    operator, modules = OPERATORS[name]
    source = "".join((FOLDER / f"{m}.py").read_text() for m in modules.split())
    own = {"doc_id", "text", "lang", "source", "n_chars"}
    extra = sorted(set(re.findall(r'"(_?[a-z][a-z_]*)"', source)) - own)
    assert len(extra) > 5
    rows = [
        (i, f"un texte {'abc'[i % 3]} numero {i} avec des mots" if i % 9 else None, "fr", f"s{i % 2}", 1, *[f"{c}{i}" for c in extra])
        for i in range(40)
    ]
    types = ["doc_id long", "text string", "lang string", "source string", "n_chars long", *(f"`{c}` string" for c in extra)]
    docs = spark.createDataFrame(rows, ", ".join(types))
    plain = {r.doc_id for r in operator(docs.select("doc_id", "text", "lang", "source", "n_chars")).collect()}
    out = operator(docs)
    assert out.columns == docs.columns
    found = out.collect()
    assert {r.doc_id for r in found} == plain and plain
    assert all(r[c] == f"{c}{r.doc_id}" for r in found for c in extra)
