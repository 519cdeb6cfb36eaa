"""Base phrases and templates against a direct search."""

import math
import re

from starmart.llm import licenses
from starmart.llm.queries import ORACLE_SQL

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def base_of(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(low)
    places, labels = [], set()
    for label, phrase in licenses.BASE:
        p = phrase.split()
        found = [k for k in range(len(w)) if w[k : k + len(p)] == p]
        places += found
        labels |= {label} if found else set()
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


TEXTS = [
    None, "", "...", "Released UNDER the MIT-License.", "under the mit licenses", "x under the mit license under the mit license, y apache license; version 2", "cc by nc cc by nc by nc",
    "Licensed under the GNU General Public License, version 3.", "licensed under the gnu general public\nlicense version 2 or later", "gnu general public license",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software", "free of charge to any person", "mit " * 4000, "the mit license " * 300,
    "filler é " * 20000 + "under the mit license", "License: CC BY-NC 4.0, apache license version 2.0", "Kunder the mit license",
]


def test_base_phrases_and_added_labels(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(3, TEXTS[3]), (None, TEXTS[5])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = licenses.scan(docs).collect()
    key = lambda r: str(r)
    assert sorted([(r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in got], key=key) == sorted([(i, *base_of(t)) for i, t in rows], key=key)
    by = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    assert by[7]["labels"] == "gpl-3" and by[8]["labels"] == "gpl-2" and by[9]["labels"] == "" and by[10]["labels"] == "mit"
    assert by[10]["base_labels"] == "" and by[11]["labels"] == "" and by[7]["score"] > 0.9
    for r in got:
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1
        assert (r["score"] > 0) == (r["labels"] != "")


def labels_of(rows):
    """Labels by the rule: the key phrase verbatim anywhere and enough of the weight around it."""
    words = [WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text)) for text in rows]
    weight = {w: 1 + math.log((len(rows) + 1) / (sum(w in ws for ws in words) + 1)) for t in licenses.templates() for w in t.words}
    out = []
    for ws in words:
        found = set()
        for t in licenses.templates():
            for k in range(len(ws)):
                if tuple(ws[k : k + len(t.key)]) == t.key:
                    s = k - t.key_at
                    same = sum(weight[w] for p, w in enumerate(t.words) if 0 <= s + p < len(ws) and ws[s + p] == w)
                    found |= {t.label} if round(same / sum(weight[w] for w in t.words), 6) >= licenses.MIN_SHARE else set()
        out.append(",".join(sorted(found)))
    return out


def test_headings_at_word_0_and_altered_rare_words(spark):
    texts = [
        "GNU General Public License version 3", "Creative Commons Attribution 4.0 International License", "see the file GNU General Public License version 3",
        "Redistribution and use in source and binary forms, with or without modifications, are permitted", "redistribution and use in source and binary forms",
        "subject to the rules of the Mozilla Public License, v. 2.0", "License gnu general public license version 3 gnu general public license version 2",
    ] + ["licensed under the terms or without"] * 40
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [r["labels"] for r in licenses.scan(docs).orderBy("doc_id").collect()]
    assert got == labels_of(texts)
    assert got[0] == "gpl-3" and got[1] == "cc-by" and got[3] == "bsd" and got[5] == "mpl-2"


def test_empty_table_and_plan(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert licenses.scan(docs).count() == 0
    plan = licenses.scan(spark.createDataFrame([(1, "a")], "doc_id long, text string"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_sql_is_registered():
    assert "op10_license_index" in ORACLE_SQL


def test_code_equals_sql_on_odd_texts(spark):
    """Headings at word 0, altered and cut words, repeated phrases, nulls: one row a text from code and SQL."""
    import duckdb
    import pyarrow as pa

    heads = [" ".join(t.words[k:]) for t in licenses.templates() for k in (0, 1, t.key_at)]
    altered = [" ".join("zzz" if p == k else w for p, w in enumerate(t.words)) for t in licenses.templates() for k in (0, t.key_at, len(t.words) - 1)]
    texts = TEXTS + heads + altered + [f"{a} {b}" for a, b in zip(heads, reversed(altered), strict=True)]
    rows = list(enumerate(texts))
    got = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"))
    con = duckdb.connect()
    con.register("documents", pa.table({"doc_id": [i for i, _ in rows], "text": [t for _, t in rows]}))
    cur = con.execute(ORACLE_SQL["op10_license_index"])
    names = [d[0] for d in cur.description]
    want = {r[0]: r for r in cur.fetchall()}
    found = {r["doc_id"]: tuple(r[n] for n in names) for r in got.collect()}
    assert found == want
    assert sum(bool(r[names.index("labels")]) for r in want.values()) > 40
