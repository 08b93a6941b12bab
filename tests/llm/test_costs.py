"""Short ways that save work give what the long ones give."""

import random
import re

import pytest
from pyspark.sql import functions as F

from rosterweave.llm import contacts, name_parts, name_variants, ngrams
from rosterweave.llm.canonical import osa
from rosterweave.llm.contacts import phone_line
from rosterweave.llm.name_parts import parse_person
from rosterweave.llm.name_variants import spelling_groups
from rosterweave.llm.ngrams import cosine_links, gram_weights, shared
from rosterweave.storage import cut


@pytest.mark.parametrize(("local", "dense"), [(0, 0), (30, 0), (30, 256), (4096, 0), (4096, 256)])
def test_blocks_are_compared_alike_on_every_path(spark, monkeypatch, local, dense):
    monkeypatch.setattr(ngrams, "LOCAL", local)
    monkeypatch.setattr(ngrams, "DENSE", dense)
    rng = random.Random(5)
    texts = [(block, "".join(rng.choice(["ko", "sha", "ste", "mi", "fli", "ra"]) for _ in range(5))) for block, n in (("few", 25), ("many", 60)) for _ in range(n)]
    nodes = cut(spark.createDataFrame([(i, *t) for i, t in enumerate(sorted(set(texts)))], "id long, block string, text string"))
    weights = gram_weights(nodes)
    rows = nodes.collect()
    vector = {r.id: {g: x for x, g in weights.vector(r.text, ngrams.LINK_GRAMS)} for r in rows}
    want = {(p.id, q.id) for p in rows for q in rows if p.id < q.id and p.block == q.block and sum(x * vector[q.id].get(g, 0.0) for g, x in vector[p.id].items()) >= 0.36}
    got = [(r.a, r.b) for r in cosine_links(nodes, shared(weights), 0.36, near=False).collect()]
    assert want and len(got) == len(set(got)) and set(got) == want


def test_spellings_write_no_posting_for_each_gram(spark, monkeypatch):
    written = []
    monkeypatch.setattr(name_variants, "cut", lambda df, name="t", **k: written.append(name) or cut(df, name, **k))
    rows = [("full_name", f"Ann {f}") for f in ("Mivandra", "Mivanda", "Koshalti", "Koshati")] + [("full_name", "A. Mivandro")]
    groups = {r.name: r.group for r in spelling_groups(spark.createDataFrame(rows, "kind string, name string")).collect()}
    assert groups["Ann Mivandra"] == groups["Ann Mivanda"] == groups["A. Mivandro"] != groups["Ann Koshalti"]
    assert "read" in written and "postings" not in written


def test_names_of_two_words_are_read_as_the_others(monkeypatch):
    names = ["Ann Lee", "ann lee", "ANN LEE", "LEE Ann", "A Lee", "Ann L", "Dr Lee", "Ann Phd", "Ma Lee", "Test User", "No Name", "Applicant Two", "José Núñez", "Lee Ann Kim", "Mr Mr", "Ann  Lee", "Ann² Lee", "İpek Lee"]
    got = [parse_person(n) for n in names]
    monkeypatch.setattr(name_parts, "_TWO_WORDS", re.compile(r"(?!)"))
    assert got == [parse_person(n) for n in names]
    assert got[0] == got[1] == got[2] == got[3] == ("ann", "lee", "") and got[9] is None


@pytest.mark.parametrize("raw", ["(622) 555-0100", "+1 622.555.0100", "1-622-555-0100", "0091 98765 43210", "011 44 20 7946 0958", "+44 (0)20 7946 0958", "00-00-broken", "+ ", "(+", "-", "", " +91 98765/43210 ", "622 555 0100\n", "0622 555 0100", "++1 622 555 0100", "tel: 622-555-0100 x12", "+1 122 555 0100"])
def test_plain_numbers_are_read_as_the_others(value, raw, monkeypatch):
    got = value(phone_line(F.col("x")), x=raw)
    monkeypatch.setattr(contacts, "_PLAIN", r"(?!)")
    assert got == value(phone_line(F.col("x")), x=raw)


def test_edit_distance_is_that_of_the_whole_texts():
    def whole(a, b):
        d = {(i, 0): i for i in range(len(a) + 1)} | {(0, j): j for j in range(len(b) + 1)}
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
                if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                    d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
        return d[len(a), len(b)]

    rng = random.Random(1)
    for _ in range(3000):
        a, b = ("".join(rng.choice("abc") for _ in range(rng.randrange(8))) for _ in range(2))
        assert osa(a, b) == whole(a, b), (a, b)
