import numpy as np
import pytest

from rosterweave.llm.aliases import ALIASES
from rosterweave.llm.canonical import map_records, map_values, osa
from rosterweave.llm.mixing import mix
from rosterweave.llm.packing import fill_report, pack, pack_histogram
from rosterweave.llm.page_spam import find_spam
from rosterweave.llm.pii import Reader, _redact, _runs, find_pii, marginals, spans_of, train, train_on, weak_labels
from rosterweave.llm.trees import bag, predict

ENTRIES = [(1, "skill", "Python"), (2, "skill", "Apache Kafka"), (3, "skill", "C++"), (4, "title", "Graphic Designer"), (5, "title", "Teacher"), (6, "country", "Ireland"), (7, "country", "United States"), (8, "skill", "React")]


def test_distance():
    assert (osa("tpython", "python"), osa("pyhton", "python"), osa("", "ab"), osa("ab", "ba")) == (1, 1, 2, 1)


def test_canonical_entries(spark):
    cases = {
        ("skill", "pyhton"): 1, ("skill", "Kafka streams"): 2, ("skill", "8 years of C++"): 3, ("skill", " apache  kafak *****"): 2, ("skill", "bell ringing"): 0, ("skill", ""): 0, ("skill", "reakt"): 8,
        ("title", "Snr Designer, Graphic"): 4, ("title", "Teacher/Team lead"): 5, ("title", "tchr"): 5, ("title", "Ninja"): 0, ("title", "-"): 0,
        ("country", "Éire"): 6, ("country", "Irelnad / remote"): 6, ("country", "United States (US)"): 7, ("country", "n/a"): 0, ("country", "Iceland"): 0, ("title", "x" * 20000): 0,
    }
    entries = spark.createDataFrame(ENTRIES, "entry_id int, kind string, label string")
    values = spark.createDataFrame([(k, v) for k, v in cases] * 2 + [("skill", None)], "kind string, value string")
    got = {(r.kind, r.value): r.entry_id for r in map_values(values, entries).collect()}
    assert got == cases


def test_labels_and_nulls_are_no_cases(spark):
    entries = spark.createDataFrame(ENTRIES, "entry_id int, kind string, label string")
    rows = [("skill", 1, "Python"), ("skill", 2, "python"), ("skill", 3, None), ("title", 1, "Python")]
    got = {(r.kind, r.record_id): r.entry_id for r in map_records(spark.createDataFrame(rows, "kind string, record_id long, value string"), entries).collect()}
    assert got == {("skill", 2): 1, ("title", 1): 0}
    assert map_records(spark.createDataFrame([], "kind string, record_id long, value string"), entries).count() == 0


def test_alias_tables_name_labels_once():
    for kind, table in ALIASES.items():
        names = [n for names in table.values() for n in names.split(", ")]
        assert len(names) == len(set(names)) < 200, kind


@pytest.mark.parametrize("seed", range(5))
def test_packing_keeps_all_items(seed):
    rng = np.random.default_rng(seed)
    capacity = 100
    sizes = {int(s): int(n) for s, n in zip(*np.unique(rng.integers(1, 101, 400), return_counts=True), strict=True)}
    patterns = pack_histogram(sizes, capacity)
    placed: dict = {}
    for pattern, n in patterns:
        assert sum(pattern) <= capacity
        for s in pattern:
            placed[s] = placed.get(s, 0) + n
    assert placed == sizes
    bound = -(-sum(s * n for s, n in sizes.items()) // capacity)
    assert sum(n for _, n in patterns) <= 1.08 * bound + 1


def optimum(items, capacity):
    items = sorted(items, reverse=True)
    best = [len(items)]

    def place(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(items):
            best[0] = len(rooms)
            return
        for r in sorted({r for r in rooms if r >= items[i]}):
            at = rooms.index(r)
            place(i + 1, [*rooms[:at], r - items[i], *rooms[at + 1 :]])
        place(i + 1, [*rooms, capacity - items[i]])

    place(0, [])
    return best[0]


@pytest.mark.parametrize("seed", range(8))
def test_packing_is_near_the_optimum(seed):
    rng = np.random.default_rng(seed)
    items = [int(x) for x in rng.integers(3, 18, 9)]
    sizes = {s: items.count(s) for s in set(items)}
    assert sum(n for _, n in pack_histogram(sizes, 20)) <= optimum(items, 20) + 1


def test_containers(spark):
    docs = spark.createDataFrame([(i, int(n)) for i, n in enumerate([10, 25, 7, 3, 0, 10, 10, 20, 61])] + [(99, None)], "doc_id long, n_tokens long")
    specs = spark.createDataFrame([(1, 10), (2, 30), (3, 0), (4, None)], "spec_id int, capacity_tokens int")
    for buckets in (50_000, 2):
        rows = pack(docs, specs, bucket_items=buckets).collect()
        assert {r.spec_id for r in rows} == {1, 2}
        for spec, capacity in ((1, 10), (2, 30)):
            own = [r for r in rows if r.spec_id == spec]
            used: dict = {}
            for r in own:
                used[r.container_id] = used.get(r.container_id, 0) + r.n_tokens
            assert max(used.values()) <= capacity and set(used) == set(range(len(used)))
            for doc, n in ((1, 25), (8, 61), (0, 10)):
                pieces = sorted((r.piece, r.first_token, r.n_tokens) for r in own if r.doc_id == doc)
                assert sum(p[2] for p in pieces) == n
                assert [p[1] for p in pieces] == [capacity * p[0] for p in pieces]
                assert len(pieces) == (1 if n <= capacity else -(-n // capacity))
            assert {r.doc_id for r in own} == {*range(9), 99}
    assert pack(docs.limit(0), specs).count() == 0
    assert {r.spec_id: r.containers for r in fill_report(pack(docs, specs), specs).collect()}[1] == 15  # 146 tokens, 10 each


def test_mix(spark):
    rng = np.random.default_rng(4)
    docs = [(i, "big" if i % 3 else "small", int(n)) for i, n in enumerate(rng.integers(20, 400, 3000))] + [(-1, None, 5), (-2, "other", 5), (-3, "big", 0)]
    frame = spark.createDataFrame(docs, "doc_id long, source string, n_tokens long")
    targets = spark.createDataFrame([("big", 0.4, 2), ("small", 0.6, 2), ("none", 0.2, 1)], "source string, target_share double, max_repeats int")
    mixed, report = mix(frame, targets)
    rows = mixed.collect()
    assert len({r.doc_id for r in rows}) == len(rows) and all(1 <= r.copies <= 2 for r in rows)
    shares = {r.source: r for r in report.collect()}
    assert abs(shares["big"].actual_share - 0.4) < 0.01 and abs(shares["small"].actual_share - 0.6) < 0.01
    assert shares["none"].mixed_tokens == 0
    assert sorted(map(tuple, mix(frame.orderBy("n_tokens"), targets)[0].collect())) == sorted(map(tuple, rows))
    fixed = {r.source: r.mixed_tokens for r in mix(frame, targets, total_tokens=50_000)[1].collect()}
    assert abs(sum(fixed.values()) - 50_000) < 1500
    assert mix(frame.limit(0), targets)[0].count() == 0


def test_inclusion_grows_with_size(spark):
    docs = spark.createDataFrame([(i, "a", 100 if i % 2 else 400) for i in range(4000)], "doc_id long, source string, n_tokens long")
    targets = spark.createDataFrame([("a", 1.0, 1)], "source string, target_share double, max_repeats int")
    rows = mix(docs, targets, total_tokens=200_000)[0].collect()
    large, small = sum(r.n_tokens == 400 for r in rows), sum(r.n_tokens == 100 for r in rows)
    assert 1.6 < large / small < 2.4  # square root of four


def test_trees_learn():
    rng = np.random.default_rng(0)
    x = rng.random((2000, 5))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.3)).astype(float)
    forest = bag(x[:1500], y[:1500])
    assert ((predict(forest, x[1500:]) > 0.5) == y[1500:]).mean() > 0.95


def test_spam(spark):
    prose = "The works council has agreed to the new rota. She prefers small teams, and said so before we asked. We keep applications for two years and delete them afterwards."
    words = " ".join(["apply now teacher jobs cheap resume urgent vacancy salary"] * 30)
    links = "\n".join(f"https://s{i}.example/jobs/{i}" for i in range(40))
    tags = " ".join(f"#tag{i % 9}" for i in range(80))
    texts = [prose, prose * 3, words, links, tags, prose + " " + words * 2, "", None, prose + "\n" + links[:60]]
    docs = spark.createDataFrame([(i, t, "h" if i % 2 else None) for i, t in enumerate(texts * 12)], "doc_id long, text string, site string")
    got = {r.doc_id: r.spam for r in find_spam(docs).collect()}
    assert len(got) == len(texts) * 12
    assert {i for i in range(len(texts)) if got[i] >= 0.5} == {2, 3, 4, 5}
    assert find_spam(docs.limit(0)).count() == 0


SENTENCES = [
    "Spoke with {n} about the offer.", "Reports to {n}.", "asked {n} to ring back", "Call {p} after 6pm.", "Mail {e} for the portfolio.", "ID on file: {i}.", "Home address {a}, please post the contract there.", "Invoice 8312946462 settled, fee agreed.",
    "SKU 378-54-6675 reordered twice.", "Handled the Wall Street style reporting desk.", "May or Will be promoted in June.", "Worked with Kodo Foods Ltd on a contract.",
]
NAMES = ["Ann Kodobar", "Z. Brukandi", "LEO MARIVOSK", "Vandorin, Petra", "Olga"]


def texts(n, seed):
    import random

    rng = random.Random(seed)
    parts = {"n": NAMES + [f"{a} {b}" for a in ("Ida", "Tom", "Ruth") for b in ("Kelvato", "Mirgund", "Sollvar", "Dreknam")], "p": ["+1 291 778 7934", "(622) 555-0100 x12", "0044 5994 149708"], "e": ["a.b@x.example", "a at x dot example", "c[at]y[dot]example"], "i": ["913-56-2368", "QQ 12 34 56 A", "X1234567", "0169 5929 4891"], "a": ["Flat 7, 30 Kroga St.", "38 rue Dremo", "Calle Piawu 73"]}
    return [" ".join(rng.choice(SENTENCES).format(**{k: rng.choice(v) for k, v in parts.items()}) for _ in range(rng.randint(1, 5))) for _ in range(n)]


def test_field_finds_held_out_spans():
    field = train(texts(1200, 1))
    held = texts(200, 2)
    reader, right, found, wanted = Reader(), 0, 0, 0
    for i, spans in _runs(held, field):
        toks, _, _ = reader(held[i])
        want = set(spans_of(toks, weak_labels(held[i], toks)))
        right, found, wanted = right + len(want & set(spans)), found + len(spans), wanted + len(want)
    assert right / found > 0.97 and right / wanted > 0.97
    assert all(_redact(t, []) == t for t in held)


def test_chain_beliefs_are_exact():
    import itertools

    rng = np.random.default_rng(0)
    unary, step = rng.normal(size=(1, 4, 7)), rng.normal(size=(7, 7))
    belief = marginals(unary, step)[0][0]
    want = np.zeros((4, 7))
    for y in itertools.product(range(7), repeat=4):
        if y[0] != 2:  # a chain does not begin inside a name
            w = np.exp(sum(unary[0, t, y[t]] for t in range(4)) + sum(step[y[t], y[t + 1]] for t in range(3)))
            for t in range(4):
                want[t, y[t]] += w
    assert np.allclose(belief, want / want.sum(axis=1, keepdims=True))


def test_texts_without_and_with_everything(spark):
    rows = [(1, None), (2, ""), (3, "nothing here"), (4, "Call +1 291 778 7934 after 6pm. " * 300), (5, "Spoke with Ann Kodobar about the offer. Mail a.b@x.example for it.")] + [(10 + i, t) for i, t in enumerate(texts(600, 3))]
    frame = spark.createDataFrame(rows, "id long, text string")
    got = {r.id: r for r in find_pii(frame, train_on(frame), "id").collect()}
    assert got[1].redacted is None and got[1].spans == [] and got[2].redacted == "" and got[3].redacted == "nothing here"
    assert len(got[4].spans) == 300
    assert got[5].redacted == "Spoke with [NAME] about the offer. Mail [EMAIL] for it."
    empty = frame.limit(0)
    assert find_pii(empty, train_on(empty), "id").count() == 0
