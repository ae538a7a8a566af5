"""Small documents with every odd case, and plain-Python counterparts."""

import random

DOCUMENTS = ("doc_id long, text string, lang string, source string, n_chars long, rank string, "
             "shard string, fp string, row string")
#: Names that the operators use inside.
CLASHING = ["x", "y", "z", "w"]


def documents(spark, texts, sources=None, ids=None):
    rows = []
    for i, text in enumerate(texts):
        own = ids[i] if ids else i
        rows.append((own, text, None if i % 5 == 0 else "en",
                     sources[i] if sources else f"src{i % 3}",
                     None if text is None else len(text), *CLASHING))
    return spark.createDataFrame(rows, DOCUMENTS)


def prose(words, seed):
    draw = random.Random(seed)
    return " ".join("".join(draw.choice("abcdefghijklmnop") for _ in range(draw.randint(2, 9)))
                    for _ in range(words))


def odd_texts():
    """Null, empty, blank and very long texts, repeats and near copies."""
    long = prose(40_000, 1)
    base = prose(200, 2)
    near = base.split()
    near[100] = "changed"
    return [None, "", "   \n\t ", "one", "two words", long, long, base, " ".join(near), base,
            prose(150, 3), "ÄÖ é 漢字 words here now", None]


def components(nodes, pairs):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for a, b in pairs:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}
