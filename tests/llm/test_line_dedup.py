"""Line deduplication against a comparison of all pairs of lines."""

import hashlib
import random
import re


from llm_tables import SMALL, docs_of  # noqa: F401

import __spark_entry__ as contract
from tidemark.llm.line_dedup import dedup_lines, one_edit

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def distance(a, b):
    """Edit distance of two sequences, the plain way."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def plain_dedup(rows):
    """Remaining texts of (doc_id, text), each id once."""
    lines = sorted((i, k, WORD.findall(lower(line))) for i, t in rows if t is not None for k, line in enumerate(t.split("\n")))
    lines = [x for x in lines if len(x[2]) >= 5]
    gone = set()
    for at, (i, k, w) in enumerate(lines):
        for _, _, v in lines[:at]:
            if w == v or (min(len(w), len(v)) >= 10 and abs(len(w) - len(v)) <= 1 and distance(w, v) <= 1):
                gone.add((i, k))
                break
    return {i: t if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if (i, k) not in gone) for i, t in rows}


def test_one_edit():
    rng = random.Random(8)
    for _ in range(3000):
        a, b = ([rng.choice("ab") for _ in range(rng.randint(0, 5))] for _ in range(2))
        assert one_edit(a, b) == (distance(a, b) <= 1)


def test_random_lines_against_all_pairs(docs_of):
    rng = random.Random(9)

    def line():
        base = [f"w{rng.randint(0, 2)}" if rng.random() < 0.1 else f"W{i}" for i in range(rng.choice([3, 5, 9, 10, 11, 12, 30]))]
        for _ in range(rng.randint(0, 2)):
            at = rng.randint(0, len(base))
            base[at : at + rng.randint(0, 1)] = [f"x{rng.randint(0, 2)}"] * rng.randint(0, 1)
        return rng.choice(["", " "]) + rng.choice([" ", "  ", "\t"]).join(base)

    rows = [(i, "\n".join(line() for _ in range(rng.randint(0, 6)))) for i in range(60)]
    got = {r.doc_id: r.text for r in dedup_lines(docs_of(rows)).collect()}
    assert got == plain_dedup(rows)


def test_edge_rows(docs_of):
    line = " ".join(f"w{i}" for i in range(12))
    near = line.replace("w5", "v5")
    long = " ".join(f"z{i}" for i in range(30_000))
    rows = [(1, None), (2, ""), (3, f"{line}\n\nshort one\n{near}\nshort one"), (4, near), (4, near), (None, f"{line} more"), (5, long), (6, long)]
    df = docs_of(rows, ["id", "line", "h", "text_hash", "near_lines", "_same"])
    out = dedup_lines(df)
    assert set(out.columns) == {*df.columns, "same_lines"}
    # The row without a key comes first of all, so lines one edit from its line go.
    by_id = {r.doc_id: r.text for r in out.collect()}
    assert by_id[None] == f"{line} more"
    assert by_id[1] is None and by_id[2] == ""
    assert by_id[3] == "\nshort one\nshort one"
    assert by_id[4] == "" and by_id[5] == long and by_id[6] == ""
    assert out.where("doc_id = 4").count() == 2
    assert dedup_lines(docs_of([])).count() == 0


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    expected = plain_dedup(rows)
    got = contract.queries()["op6_line_dedup"](spark, SMALL).collect()
    assert {r.doc_id: r.text_sha256 for r in got} == {i: hashlib.sha256((t or "").encode()).hexdigest() for i, t in expected.items()}
