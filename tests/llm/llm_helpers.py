from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict

LONG = "river stone " * 9000 + "end"

#: Columns that have the names of results or of columns that operators use within.
CLASHING = {
    name: "'kept as it was'"
    for name in ("block", "node", "part", "words", "seed", "digest", "bucket", "number", "rep", "tie")
}


def odd_texts():
    """Texts of all the kinds that must not break an operator, by doc_id."""
    return [
        (1, None),
        (2, ""),
        (3, " \n\t "),
        (4, "word"),
        (5, "word"),
        (6, "?!... --- !!!"),
        (7, "É ñandú 中文 ٣ é \x00\x0b <|endoftext|> 🙂"),
        (8, LONG),
        (9, LONG),
        (10, "the quick brown fox jumps over the lazy dog near the old stone bridge by the river"),
        (10, "the quick brown fox jumps over the lazy dog near the old stone bridge by the river"),
        (11, "Year 1999: the 42nd flood, the 7th dam."),
        (None, "a text without an id"),
        (None, None),
    ]


def fold(doc_id, folds):
    return zlib.crc32(str(doc_id).encode()) % folds


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def of_sql(duck, sql, columns):
    found = duck.execute(sql)
    names = [x[0] for x in found.description]
    assert sorted(names) == sorted(columns)
    return sorted((tuple(r[names.index(c)] for c in columns) for r in found.fetchall()), key=str)


def kept_columns(result, given):
    """The columns of the input that an operator must leave alone are as they were."""
    names = [c for c in CLASHING if c in result.columns]
    assert names == [c for c in given.columns if c in CLASHING]
    assert result.select(*names).distinct().collect() == given.select(*names).distinct().collect()


TOKEN = re.compile(r"(?:[0-9a-z]|[^\x00-\x7f])+")


def bag(text, size=5):
    words = TOKEN.findall((text or "").lower())
    count = max(1, len(words) - size + 1) if words else 0
    return Counter(tuple(words[k : k + size]) for k in range(count))


def similarity(left, right):
    united = sum((left | right).values())
    return sum((left & right).values()) / united if united else 0.0


def similar_classes(docs, threshold=0.8):
    """Least ids of the components, by comparing every two documents that share a shingle."""
    bags, holders = [bag(t) for _, t in docs], defaultdict(list)
    above = list(range(len(docs)))

    def root(k):
        while above[k] != k:
            k = above[k]
        return k

    for k, own in enumerate(bags):
        for other in {m for s in own for m in holders[s]}:
            if similarity(own, bags[other]) >= threshold:
                above[root(k)] = root(other)
        for s in own:
            holders[s].append(k)
    members = defaultdict(list)
    for k, (number, _) in enumerate(docs):
        members[root(k)].append(number)
    least = {r: min(m, key=lambda x: (x is not None, x)) for r, m in members.items()}
    return [(n, least[root(k)], len(members[root(k)])) for k, (n, _) in enumerate(docs)]


def windows_of(text, depth=50):
    raw = text.encode()
    return [raw[k : k + depth] for k in range(len(raw) - depth + 1)]
