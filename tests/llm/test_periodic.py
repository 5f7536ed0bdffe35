from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from llm.llm_helpers import kept_columns, rows

from tidegauge.llm import periodic, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_force(words, min_length=12):
    """(start, length, period) of all runs, by trying every period."""
    least = {}
    for p in range(1, len(words) // 2 + 1):
        x = 0
        while x < len(words) - p:
            y = x
            while y < len(words) - p and words[y] == words[y + p]:
                y += 1
            if y + p - x >= max(min_length, 2 * p):
                least.setdefault((x, y + p), p)
            x = max(y, x + 1)
    return sorted(((s, e - s, p) for (s, e), p in least.items()), key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {k for s, n, p in runs for k in range(s + p, s + n)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


def contract_row(doc_id, text):
    words = WORD.findall(text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n > 0:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_force(words)
    lines = "".join(f"{s},{m},{p}\n" for s, m, p in runs)
    top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    exponent = None if top[0] is None else 1000 * top[1] // top[2]
    digests = (hashlib.sha256(x.encode()).hexdigest() for x in (lines, collapsed(words, runs)))
    return (doc_id, len(runs), *top, exponent, *digests)


def test_query_equals_brute_force(spark, sf_dir):
    result = queries.queries()["op11_periodic_runs"](spark, sf_dir)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    found = {r.doc_id: tuple(r) for r in result.collect()}
    # Trying every period is quadratic: that check takes the texts of up to 700 words.
    short = [d for d in docs if len(WORD.findall(d.text or "")) <= 700]
    assert len(short) > 150
    assert [found[d.doc_id] for d in short] == [contract_row(*d) for d in short]
    assert len(found) == len(docs)
    assert sum(r[1] for r in found.values()) > 0


@pytest.mark.parametrize("letters", [1, 2, 3, 6])
def test_random_words(letters):
    pick = random.Random(letters)
    for _ in range(250):
        words = [pick.randrange(letters) for _ in range(pick.randrange(80))]
        if len(words) > 4 and pick.random() < 0.6:
            a = pick.randrange(len(words) - 3)
            p = pick.randrange(1, (len(words) - a) // 2 + 1)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        least = pick.choice([2, 4, 12])
        found = periodic.find_runs(np.array(words, np.int64), least)
        assert list(zip(*(x.tolist() for x in found))) == brute_force(words, least)


def test_many_proposals_are_extended_in_parts(monkeypatch):
    words = [k % 3 for k in range(500)] + [7] + [k % 25 for k in range(400)]
    whole = periodic.find_runs(np.array(words))
    monkeypatch.setattr(periodic, "PROPOSALS", 50)
    parts = periodic.find_runs(np.array(words))
    assert [x.tolist() for x in whole] == [x.tolist() for x in parts]
    assert (0, 500, 3) in list(zip(*(x.tolist() for x in whole)))


def test_odd_texts(spark, odd, monkeypatch):
    monkeypatch.setattr(periodic, "SLICE_BYTES", 400)
    result = periodic.periodic_runs(odd)
    kept_columns(result, odd)
    for r in result.collect():
        words = WORD.findall(r.text or "")
        if len(words) > 1000:
            wanted = [(0, len(words) - 1, 2)]
        else:
            wanted = brute_force(words)
        assert [tuple(x) for x in r.runs] == wanted
        assert (r.n_runs, r.kept) == (len(wanted), collapsed(words, wanted))


def test_names_that_are_taken(spark):
    df = spark.createDataFrame([("a " * 14, 5, "x"), (None, 6, "y")], "text string, runs int, KEPT string")
    result = periodic.periodic_runs(df, min_length=4)
    assert result.columns == ["text", "runs", "kept", "n_runs"]
    assert rows(result.select("n_runs", "kept")) == [(0, ""), (1, "a")]


def test_empty_table(spark, nothing):
    assert periodic.periodic_runs(nothing).collect() == []
