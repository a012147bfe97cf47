"""License scans against plain containment."""

import random
import re

import pytest
from llm_tables import MIDDLE, docs_of  # noqa: F401
from oracle import assert_same, connect

import __spark_entry__ as contract
from tidemark.llm.license_scan import scan_licenses
from tidemark.llm.license_texts import TEMPLATES


def plain_shingles(text):
    words = [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]
    return [tuple(words[i : i + 5]) for i in range(len(words) - 4)]


def plain_scan(rows, templates):
    out = set()
    for i, text in rows:
        own = plain_shingles(text)
        for name, template in templates.items():
            wanted = set(plain_shingles(template))
            both = wanted & set(own)
            if len(both) >= 0.8 * len(wanted):
                out.add((i, name, len(both) / len(wanted), min(k for k, s in enumerate(own) if s in wanted)))
    return out


def test_copies_whole_and_cut(docs_of):
    rng, rows = random.Random(17), []
    for i in range(400):
        name = rng.choice(sorted(TEMPLATES))
        words = TEMPLATES[name].split()
        for _ in range(rng.choice([0, 0, 1, 2])):
            words[rng.randrange(len(words))] = "changed"
        cut = rng.choice([0, 0, 1, 3])
        words = words[cut : len(words) - rng.choice([0, 0, 2])]
        filler = ["".join(rng.choice("abcde") for _ in range(3)) for _ in range(rng.randint(0, 40))]
        at = rng.randint(0, len(filler))
        rows.append((i, " ".join(filler[:at]) + "\n" + rng.choice([" ", "  ", " * "]).join(words) + "\n" + " ".join(filler[at:])))
    got = {tuple(r) for r in scan_licenses(docs_of(rows)).collect()}
    expected = plain_scan(rows, TEMPLATES)
    assert len(expected) > 200
    assert got == expected


def test_edge_rows(docs_of):
    notice = TEMPLATES["MIT-line"].upper()
    rows = [(1, None), (2, ""), (3, "four words are few"), (4, notice), (4, notice), (None, notice), (5, "x " * 60_000 + notice)]
    got = sorted((r.doc_id or 0, r.license, r.containment, r.first_word) for r in scan_licenses(docs_of(rows, ["license", "hits", "s", "w"])).collect())
    assert got == [(0, "MIT-line", 1.0, 0), (4, "MIT-line", 1.0, 0), (4, "MIT-line", 1.0, 0), (5, "MIT-line", 1.0, 60_000)]
    assert scan_licenses(docs_of([])).count() == 0
    assert scan_licenses(docs_of(rows), {}).count() == 0
    with pytest.raises(ValueError, match="fewer than 5 words"):
        scan_licenses(docs_of(rows), {"x": "too short"})


def test_no_python_and_no_shuffle(spark):
    plan = contract.queries()["op1_license_scan"](spark, MIDDLE)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Exchange", plan)


def test_query(spark):
    assert assert_same(contract.queries()["op1_license_scan"](spark, MIDDLE), connect(MIDDLE), contract.oracle_sql()["op1_license_scan"])
