import random
import re

from helpers import documents, odd_texts

from rosterloom.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def digits(text):
    return re.sub("[^0-9]", "", text)


def brute(text):
    spans = [(0, m.start(), m.end()) for m in EMAIL.finditer(text)]
    spans += [(1, m.start(), m.end()) for m in IP.finditer(text)
              if all(int(x) <= 255 for x in m[0].split("."))]
    spans += [(2, m.start(), m.end()) for m in CARD.finditer(text)
              if 16 <= len(digits(m[0])) <= 19 and pii.luhn(digits(m[0]))]
    spans += [(3, m.start(), m.end()) for m in PHONE.finditer(text)
              if 8 <= len(digits(m[0])) <= 15]
    return spans


def test_base_spans_equal_plain_patterns():
    draw = random.Random(4)
    parts = ["a", "B", "@", "@", ".", ".", "-", "+", "1", "2", "55", "300", " ", "(", ")", "%", "é",
             "4111111111111111", "a@b.c", "1.2.3.4", "+1 234 5678", "4111 1111 1111 1111"]
    for _ in range(20_000):
        text = "".join(draw.choice(parts) for _ in range(draw.randint(1, 14)))
        assert pii.base_spans(text) == brute(text), text
    assert pii.base_spans("0" * 5000 + ".1.1.1") == [(1, 0, 5006)]


def test_luhn():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")


def test_odd_rows(spark):
    texts = odd_texts() + ["mail a.b@c.de, 10.0.0.1 and 4111-1111-1111-1111; +49 (30) 1234567"] * 2
    docs = documents(spark, texts)
    rows = pii.find(docs.union(docs), ["doc_id", "row"]).collect()
    assert len(rows) == 2 * len(texts)
    for r in rows:
        assert [tuple(x) for x in r["base"]] == brute(texts[r["doc_id"]] or "")
        assert r["added"] == []
    assert pii.find(docs.limit(0), ["doc_id"]).count() == 0


def test_contexts_discover_unseen_identifiers(spark):
    texts = [f"please call me on +1 555 010 {i:04d} any time" for i in range(30)]
    texts += ["please call me on (555) 010-9999 any time",  # unseen, in a known context
              "the order 1234567890 was shipped to them",  # unseen, in an unknown context
              "please call me on order 77 any time"]
    texts += [f"write to bob{i}@ex.com for details" for i in range(12)]
    texts += ["write to ann (at) ex (dot) com for details"]
    found = pii.find(documents(spark, texts), ["doc_id"]).where("size(added) > 0").collect()
    assert {r["doc_id"]: [(pii.KINDS[x["no"]], texts[r["doc_id"]][x["start"]:x["end"]])
                          for x in r["added"]] for r in found} == {
        30: [("phone", "(555) 010-9999")], 45: [("email", "ann (at) ex (dot) com")]}


def test_mixed_contexts_are_not_trusted(spark):
    texts = [f"seen near +1 555 010 {i:04d} by us" for i in range(10)]
    texts += [f"seen near 8{i:09d}7 by us" for i in range(10)]
    assert pii.find(documents(spark, texts), ["doc_id"]).where("size(added) > 0").count() == 0


def added(spark, texts):
    found = pii.find(documents(spark, texts), ["doc_id"]).where("size(added) > 0").collect()
    return {r["doc_id"]: [(pii.KINDS[x["no"]], texts[r["doc_id"]][x["start"]:x["end"]])
                          for x in r["added"]] for r in found}


def test_other_spellings_of_seeds_are_added(spark):
    texts = ["paid by 4111 1111 1111 1111", "4111.1111.1111.1111", "4111.1111.1111.1112",
             "at 30.0.111.11 now", "300.0.111.11"]  # equal digits, other parts
    assert added(spark, texts) == {1: [("card", "4111.1111.1111.1111")]}


def test_long_chains_of_contexts_are_followed(spark):
    texts, links = [], 9
    for k in range(links):
        c = chr(97 + k) * 3
        context = f"{c}x {c}y {{}} {c}v {c}w"
        texts += [context.format(f"+1 555 {k}10 {i:04d}") for i in range(9)]
        # Each pattern is trusted only when the number of the pattern before is known.
        texts += [context.format(f"(555) 77{n}-1234") for n in (k - 1, k) if n >= 0]
    found = added(spark, texts)
    assert found == {i: [("phone", t[t.index("("):t.index("34") + 2])]
                     for i, t in enumerate(texts) if "(" in t}
