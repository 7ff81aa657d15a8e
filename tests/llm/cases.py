"""Small awkward tables and plain-Python references for the text operators."""

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, score string"
WS = "[\x20\x09-\x0d]"


def words_text(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def awkward(rng=None):
    """(doc_id, text) rows: nulls, empty and white texts, copies, near copies, repeated rows and ids, a very long text."""
    rng = rng or random.Random(5)
    base = words_text(rng, 120)
    near = base.split()
    near[60] = "changed"
    long_text = words_text(rng, 9000, 3000)
    rows = [(0, base), (1, base), (2, " ".join(near)), (3, base.replace(" ", "\n\t")), (4, ""), (5, None), (6, " \n"), (7, "one"),
            (8, "one two"), (9, "ONE two"), (10, "one two three"), (11, long_text), (12, long_text + " end"), (None, "no id here at all"),
            (None, "no id here at all"), (None, None), (13, "same id"), (13, "other text, same id"), (14, "again"), (14, "again"),
            (15, "a" * 700), (16, "ab" * 500), (17, "É" * 300 + " ünï " * 60)]
    for i in range(20, 50):
        rows.append((i, words_text(rng, rng.randrange(1, 200))))
    for i in range(50, 56):
        cut = rng.randrange(100)
        rows.append((i, " ".join(near[:cut] + ["x%d" % i] + near[cut + 1:])))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", None, "r", "s") for i, t in rows], SCHEMA)


def shingles(text, n):
    ws = [w for w in re.split(WS + "+", re.sub("[A-Z]", lambda m: m.group().lower(), text or "")) if w]
    return {tuple(ws[i:i + n]) for i in range(max(1, len(ws) - n + 1))} if ws else set()


def component_ids(rows, n, least):
    """(size, least id) by row, by comparing all pairs."""
    sets = [shingles(t, n) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= least * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least_id = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least_id[find(i)] = min(key, least_id.get(find(i), key))
    return [(len(sets[i]), least_id.get(find(i))) for i in range(len(rows))], [find(i) for i in range(len(rows))]
