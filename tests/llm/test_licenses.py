import pytest
from helpers import documents, odd_texts, prose

from rosterloom.llm import licenses


def brute(text, least=licenses.DICE):
    found = {}
    for passage in licenses.passages(text or ""):
        own = licenses.bigrams(passage)
        for i, (_, template) in enumerate(licenses.TEMPLATES):
            other = licenses.bigrams(template)
            shared = sum((own & other).values())
            total = sum(own.values()) + sum(other.values())
            if total and 2 * shared / total >= least:
                found[i] = max(found.get(i, 0), 2 * shared / total)
    top = max(found, key=lambda i: (found[i], -i), default=None)
    return (None if top is None else licenses.TEMPLATES[top][0], found.get(top),
            sorted({licenses.TEMPLATES[i][0] for i in found}))


def changed(text, every):
    words = text.split()
    return " ".join("x" if i % every == every - 1 else w for i, w in enumerate(words))


TEXTS = odd_texts() + [
    "Licensed under CC BY-NC 4.0.\n" + prose(300, 1), prose(30, 2) + "\nlicensed UNDER cc-by 4.0",
    licenses.MIT, changed(licenses.MIT, 12), changed(licenses.MIT, 4), licenses.ISC + "\n\n" +
    licenses.APACHE, "Copyright me\n\n" + licenses.GPL.format(3) + "\n\nint main;", "Licensed",
    "Released under the MIT License.\nLicensed under the Apache License, Version 2.0."]


@pytest.mark.parametrize("least", [0.5, 0.8, 1.0])
def test_matches_equal_comparison_with_every_template(spark, least):
    rows = licenses.find(documents(spark, TEXTS), ["doc_id", "row"], least=least).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        name, dice, names = brute(TEXTS[r["doc_id"]], least)
        assert (r["license"], r["licenses"]) == (name, names)
        assert r["dice"] == pytest.approx(dice)


def test_size_bounds_let_in_what_lies_on_them():
    words = [f"w{i}" for i in range(13)]
    known = licenses.Templates([("T", " ".join(words))], 0.8)  # 12 bigrams
    assert known.best(" ".join(words[:9])) == [(0.8, 0)]  # 8 bigrams, all shared
    assert known.best(" ".join(words[:8])) == []


def test_empty_table(spark):
    assert licenses.find(documents(spark, ["a"]).limit(0), ["doc_id"]).count() == 0


def paragraphs(text, *starts):
    for start in starts:
        at = text.index(start)
        text = f"{text[:at].rstrip()}\n\n{text[at:]}"
    return text


NOTICES = [
    ("MIT", paragraphs(licenses.MIT, "The above", "THE\nSOFTWARE")),
    ("Apache-2.0", paragraphs(licenses.APACHE, "http:", "Unless")),
    ("GPL-3.0-or-later", paragraphs(licenses.GPL.format(3), "This program is distributed")),
    ("BSD-3-Clause", paragraphs(licenses.BSD.format(licenses.BSD_3), "2.", "3.", "THIS")),
    ("BSD-2-Clause", licenses.BSD.format("")), ("LGPL-3.0-or-later", licenses.LGPL.format(3)),
    ("AGPL-3.0-or-later", licenses.AGPL.format(3)), ("Unlicense", licenses.UNLICENSE)]


def test_notices_in_paragraphs_and_beside_other_words(spark):
    def around(notice, i):
        return [prose(400, i) + "\n\n" + notice + "\n\n" + prose(400, i + 50),
                "int a;\n" + notice + "\nint main() { return 0; }\n" * 40,
                prose(90, i) + " " + " ".join(notice.split()) + " " + prose(90, i + 50),
                "# " + notice.replace("\n", "  \n #   \t   \t  ")]
    cases = [(name, t) for i, (name, notice) in enumerate(NOTICES) for t in around(notice, i)]
    rows = licenses.find(documents(spark, [t for _, t in cases]), ["doc_id"]).collect()
    assert {r["doc_id"]: (r["license"], r["dice"]) for r in rows} == {
        i: (name, 1.0) for i, (name, _) in enumerate(cases)}


def test_the_best_run_of_words_is_found():
    known = licenses.Templates([("T", "a b c d a b e")], 0.5)
    for words in ("x a b y c d a b e z", "a b a b a b c d", "a x b c d a b q a b e", "a b"):
        all_ = words.split()
        runs = [" ".join(all_[i:j]) for i in range(len(all_)) for j in range(i + 2, len(all_) + 1)]
        assert max((x for p in licenses.passages(words, known) for x in known.best(p)),
                   default=None) == max((x for p in runs for x in known.best(p)), default=None)
