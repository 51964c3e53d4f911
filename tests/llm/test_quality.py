import re

from affinity.llm.quality import quality_rules
from cases import docs, sentences, texts


def brute(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    seen, dup = set(), 0
    for line in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    at = {}
    for i in range(len(w) - 2):
        at.setdefault(tuple(w[i:i + 3]), []).append(i)
    covered = {p for v in at.values() if len(v) > 1 for i in v for p in (i, i + 1, i + 2)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dup, len(covered), len(w) < 50 or 100 * len(covered) > 50 * len(w))


def test_base_figures_match_brute_force(spark):
    some = texts() + ["a | b & c\n" * 60, "x y z x y z", sentences(9, 60) + "\n" + sentences(9, 60)]
    got = {r.doc_id: r for r in quality_rules(docs(spark, some)).collect()}
    for i, t in enumerate(some):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(t), i
        assert not (r.base_failed and r.kept)


def test_lines_go_first_then_documents(spark):
    clean = sentences(5, 240)
    nav = "Home | News | Sport | Shop | About us | Contact | Help | Login | Imprint | Jobs"
    licence = "This work is licensed under the GNU General Public License, version 3."
    junk = "\n".join(f"Go{i}!! {i}BUY!! NOW{i}!! {i * 7}!! ${i}$ MORE{i * 3}!! ALL{i}!!" for i in range(40))
    got = {r.doc_id: r for r in quality_rules(docs(spark, [clean, clean + "\n" + nav + "\n" + licence, junk + "\n" + clean[:200]])).collect()}
    assert got[0].kept and got[0].n_bad_lines == 0 and got[0].clean_text == clean
    assert got[1].kept and got[1].n_bad_lines == 2 and got[1].clean_text == clean
    assert not got[2].kept and not got[2].base_failed


def test_nulls_repeats_and_empty_table(spark):
    d = docs(spark, [None, "", sentences(6, 100), sentences(6, 100)], [1, 1, None, None])
    rows = quality_rules(d).collect()
    assert len(rows) == 4 and sum(r.kept for r in rows) == 2
    assert quality_rules(d.limit(0)).count() == 0


SENTENCES = ["She baked a cookie for her son.", "The court ruled on copyright in 1998.", "JavaScript was designed in ten days.",
             "He had to sign up for the army.", "Many subscribe to the theory of plates.", "\u4ed6\u8d70\u4e86\uff01", "\u0935\u0939 \u0917\u092f\u093e\u0964",
             "\u0644\u0645\u0627\u0630\u0627\u061f"]
NOTICES = ["This site uses cookies to work better.", "Copyright 1998 by the publisher, London.", "Please enable JavaScript to see this page.",
           "Sign up for our newsletter and be the first to know.", "Subscribe to our channel for more of this.", "(c) 2004 The authors of this page.",
           "Read our cookie policy to learn what is stored.", "JavaScript must be enabled in your browser."]


def test_sentences_stay_and_notices_go(spark):
    body = sentences(7, 120)
    got = {r.doc_id: r for r in quality_rules(docs(spark, [f"{body}\n{x}" for x in SENTENCES + NOTICES])).collect()}
    assert [got[i].n_bad_lines for i in range(len(SENTENCES))] == [0] * len(SENTENCES)
    assert [got[len(SENTENCES) + i].clean_text for i in range(len(NOTICES))] == [body] * len(NOTICES)
