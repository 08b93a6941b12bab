import json

import pytest
from pyspark.sql import functions as F

from rosterweave.operators import check as C, merge as M, profile as P, project as J, resolve as R, score as S, validate as V
from rosterweave.plans.pipeline import build_profiles, main, run
from rosterweave.sources.people import aligned

# The records and results of the golden case.
EXPORT = dict(record_ix=1, source="recruiter.csv", full_name="John Smith", email="john.smith@email.com", phone="+1-415-555-0101", location_city="San Francisco", location_country="United States", linkedin="https://linkedin.com/in/johnsmith", skills_text="Python, SQL, Docker", years_experience="5")
GARBAGE = dict(record_ix=2, source="recruiter.csv", full_name="J0hn Smyth", email="not-an-email", phone="000-GARBAGE", location_country="Narnia", linkedin="just-text-not-url", skills_text="", years_experience="abc")
RESUME = dict(record_ix=3, source="resume.pdf", full_name="John Smith", emails=["john.smith@email.com"], phones=["+1 (415) 555-0101"], github="https://github.com/johnsmith", skills_list=["Python", "Go", "K8S", "REST API"], years_experience="6.9", experience=[("Acme", "SWE", "2021-03", None, None)], education=[("UC Berkeley", "B.S.", "CS", None, None, 2019)])


@pytest.fixture
def raw(spark):
    from pyspark.sql.types import StructType

    from rosterweave.schema import RAW

    schema = StructType.fromDDL(RAW)

    def make(*records):
        return aligned(spark.createDataFrame([tuple(r.get(f) for f in schema.names) for r in records], schema))

    return make


def test_clean_and_garbage(raw):
    rows = {r.record_ix: r for r in V.validate(raw(EXPORT, GARBAGE)).collect()}
    assert rows[1].validation_log == []
    assert [x.field for x in rows[2].validation_log] == ["email", "phone", "location_country", "linkedin", "years_experience"]
    assert rows[1].skills == ["python", "sql", "docker"] and rows[2].skills == []


def test_one_person_from_export_and_resume(raw):
    p = build_profiles(raw(EXPORT, RESUME)).collect()
    assert len(p) == 1
    p = p[0]
    assert p.candidate_id == "ffa7ca146a200566"
    assert (p.full_name, p.location.city, p.location.country, p.years_experience) == ("John Smith", "San Francisco", "US", 6.9)
    assert (p.emails, p.phones) == (["john.smith@email.com"], ["+14155550101"])
    assert [(s.name, s.confidence) for s in p.skills] == [("python", 0.8325), ("sql", 0.7), ("docker", 0.7), ("go", 0.595), ("kubernetes", 0.595), ("rest apis", 0.595)]
    assert p.overall_confidence == 0.8499
    assert len(p.provenance) == 15
    assert [x.method for x in p.provenance if x.field == "years_experience"] == ["merge_conflict_resume_won"]


def keyed(raw, *people):
    return R.keys(V.validate(raw(*[dict(record_ix=i, source="a.pdf", full_name=n, emails=e, phones=p) for i, (n, e, p) in enumerate(people)])))


@pytest.mark.parametrize(
    ("people", "clusters"),
    [
        ([("John", ["test@example.com"], []), ("Jonathan", ["test@example.com"], [])], 1),
        ([("Robert Smith", [], ["+14155550101"]), ("Rob Smith", [], ["+14155550101"])], 1),
        ([("Robert Smith", [], []), ("Rob Smith", [], [])], 2),
        ([("Alice", ["a@example.com"], []), ("Bob", ["b@example.com"], [])], 2),
        ([("john lee", [], ["+14155550101"]), ("john li", [], ["+14155550101"])], 2),
        ([], 0),
    ],
)
def test_matching(raw, people, clusters):
    records = [dict(record_ix=i, source="a.pdf", full_name=n, emails=e, phones=p) for i, (n, e, p) in enumerate(people)]
    assert R.clusters(V.validate(raw(*records))).select("cluster_id").distinct().count() == clusters


def test_clusters_do_not_depend_on_the_order(raw, spark):
    import random

    chain = [dict(record_ix=i, source="a.csv", full_name=f"n{i}", emails=[f"a{i}@x.org", f"a{i + 1}@x.org"]) for i in range(12)]
    random.Random(1).shuffle(chain)
    assert {r.cluster_id for r in R.clusters(V.validate(raw(*chain))).collect()} == {0}


def test_conflicts(raw):
    a = dict(record_ix=1, source="data.csv", full_name="Jonathan Doe", email="jon@example.com", years_experience="5")
    b = dict(record_ix=2, source="resume.pdf", full_name="John Doe", emails=["j@example.com"], years_experience="6")
    m = M.merge(V.validate(raw(a, b)).withColumn("cluster_id", F.lit(1))).collect()[0]
    assert (m.full_name, m.years_experience, m.emails, m.merged_sources) == ("Jonathan Doe", 6.0, ["jon@example.com", "j@example.com"], ["data.csv", "resume.pdf"])


def test_indian_numbers_lead_and_collapse(raw):
    a = dict(record_ix=1, source="a.csv", full_name="A B", phones=["+14155550101", "+19876543210"])
    b = dict(record_ix=2, source="b.pdf", full_name="A B", phones=["+919876543210"])
    m = M.merge(V.validate(raw(a, b)).withColumn("cluster_id", F.lit(1))).collect()[0]
    assert m.phones == ["+919876543210", "+14155550101"]


def test_projection_paths(raw):
    p = build_profiles(raw(EXPORT, RESUME))
    config = J.parse_config({"fields": [{"path": "name", "from": "full_name"}, {"path": "city", "from": "location.city"}, {"path": "mail", "from": "emails[0]"}, {"path": "third", "from": "emails[2]"}, {"path": "skills", "from": "skills[].name"}, {"path": "none", "from": "a.b.c"}], "include_provenance": False})
    r = J.project(p, config).collect()[0]
    assert (r.name, r.city, r.mail, r.third, r.none) == ("John Smith", "San Francisco", "john.smith@email.com", None, None)
    assert r.skills[0] == "python"
    omit = J.parse_config({"fields": [{"path": "name", "from": "full_name"}, {"path": "third", "from": "emails[2]"}], "on_missing": "omit", "include_provenance": False, "include_confidence": False})
    assert json.loads(J.project_json(p, omit).first()[0]) == {"name": "John Smith"}
    error = J.parse_config({"fields": [{"path": "third", "from": "emails[2]", "on_missing": "error"}]})
    assert J.project(p, error).count() == 0


def test_output_check(spark):
    rows = spark.createDataFrame([(None, "thirty"), ("a", "x")], "email string, age string")
    config = J.parse_config({"fields": [{"path": "email", "type": "string", "required": True}, {"path": "age", "type": "number"}], "include_confidence": False, "include_provenance": False})
    got = {r.age: r for r in C.check(rows, config).collect()}
    assert got["thirty"].should_abort and len(got["thirty"].violations) == 1
    assert not got["x"].should_abort and len(got["x"].warnings) == 1
    strict = J.parse_config({"fields": [{"path": "age", "type": "number", "required": True}], "include_confidence": False, "include_provenance": False})
    assert C.valid_only(C.check(rows, strict)).count() == 0


def test_normalising_structs_is_refused_at_plan_time(raw):
    with pytest.raises(ValueError, match="cannot be applied"):
        J.project(build_profiles(raw(EXPORT)), J.parse_config({"fields": [{"path": "skills", "normalize": "canonical"}]}))


def test_counts_add_up(raw):
    config = J.parse_config(None)
    p = build_profiles(raw(EXPORT, GARBAGE, RESUME))
    checked = C.check(J.project(p, config, "cluster_id"), config)
    assert checked.count() == p.count() == C.valid_only(checked).count() + checked.where("should_abort").count()
    assert run(raw(EXPORT, GARBAGE), config).count() == 2


def test_confidence_of_skills(value):
    assert value(S.skill_confidence(F.array(F.lit("a.csv"), F.lit("b.pdf"), F.lit("a.csv")))) == 0.8325


def test_phone_alone_gives_no_identifier(value):
    none = F.array().cast("array<string>")
    assert value(P.candidate_id(none, F.lit(None).cast("string"), F.array(F.lit("+14155550101")))) is None


def test_command_line(spark, tmp_path):
    (tmp_path / "a.csv").write_text('name,email,phone,skills,years_experience\nJohn Smith,john@x.org,415-555-0101,"Python, SQL",5\n"Short ""Row""",s@x.org\nlong,l@x.org,1,2,3,4\n')
    (tmp_path / "r.txt").write_text("John Smith\njohn@x.org | Delhi, India\nData Engineer\nSKILLS\nLanguages: Python, AWS (Cloud), C\nEXPERIENCE\nAcme Corp\nEngineer\nJan 2022 - Present\n- built\n")
    out = tmp_path / "out.json"
    assert main(["--csv", str(tmp_path / "a.csv"), "--resume", str(tmp_path / "r.txt"), "--output", str(out)], spark) == 0
    people = json.loads(out.read_text())
    assert {p["full_name"] for p in people} == {"John Smith", 'Short "Row"'}
    assert main(["--csv", str(tmp_path / "none.csv")], spark) == 1
    assert main([], spark) == 2
    assert main(["--csv", str(tmp_path / "a.csv"), "--config", str(tmp_path / "none.json")], spark) == 2


def test_stream(spark, raw, tmp_path):
    from rosterweave.streaming.records import append_validated

    raw(EXPORT, GARBAGE).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(raw(EXPORT).schema).parquet(str(tmp_path / "in"))
    append_validated(stream, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_merged_queries_cover_the_whole_clusters(spark, small):
    from collections import defaultdict

    from rosterweave.operators.merge import KIND, LINKS, SCALARS
    from rosterweave.plans import registry

    members = defaultdict(list)
    for r in registry._clustered(spark, small).orderBy("record_ix").collect():
        members[r.cluster_id].append(r)
    assert any(r.email is None for rs in members.values() if len(rs) > 1 for r in rs)
    first = lambda rs, c: next((r[c] for r in rs if r[c] is not None), None)
    want = {"cluster_scalars": {}, "cluster_links": {}, "cluster_sources": {}}
    for ix, rs in members.items():
        preferred = {c: sorted(rs, key=lambda r, k=KIND[p]: r.source_type != k) for c, p in SCALARS.items()}
        want["cluster_scalars"][ix] = (len(rs), *[first(preferred[c], c) for c in SCALARS])
        want["cluster_links"][ix] = tuple(first(rs, c) for c in LINKS)
        want["cluster_sources"][ix] = ("|".join(dict.fromkeys(r.source for r in rs)),)
    for name, rows in want.items():
        got = {r.cluster_id: tuple(r)[1:] for r in registry.queries()[name](spark, small).collect()}
        assert got == rows, name


def test_near_names_lose_no_pair(spark):
    """Against all pairs, short and repetitive names included, hot grams spread or not."""
    import random

    from rosterweave.functions.text import _lcs
    from rosterweave.storage import cut

    rng = random.Random(8)
    names = {"".join(rng.choices("ab cd", k=rng.randint(1, 14))).strip() or "a" for _ in range(120)} | {"aaaaaaaa", "aaaaaaa", "aaaaaab", "a", "ab"}
    names |= {n[:i] + rng.choice("abe") + n[i:] for n in sorted(names) for i in (0, len(n) // 2)}
    rows = [("+1", n, i) for i, n in enumerate(sorted(names))] + [("+2", "alone", 9000)]
    table = cut(spark.createDataFrame(rows, "phone string, name string, ix long"))
    for threshold in (85.0, 67.0):
        want = {(a, b) for _, a, _ in rows[:-1] for _, b, _ in rows[:-1] if a < b and 200 * _lcs(a, b) / (len(a) + len(b)) >= threshold}
        for hot in (512, 20):
            got = [(r.na, r.nb) for r in R.near_names(table, threshold, hot).collect()]
            assert len(got) == len(set(got)) and set(got) == want


def test_exports_of_many_files(spark, tmp_path, caplog):
    from rosterweave.sources.files import RESUME_BASE, read_csvs

    for i in range(150):
        head = "name,email" if i % 2 else "email,name,odd"
        row = f'"Ann\nof {i}",a{i}@x.org' if i % 2 else f"b{i}@x.org,Bob {i},?"
        (tmp_path / f"f+{i:03} é.csv").write_text(f"{head}\n{row}\nSecond,s{i}@x.org\n" if i % 2 else f"{head}\n{row}\n")
    rows = sorted(read_csvs(spark, [str(tmp_path)]).select("record_ix", "source", "full_name", "email").collect())
    assert len(rows) == 225 and len({r.record_ix for r in rows}) == 225 and rows[-1].record_ix < RESUME_BASE
    assert [r.source for r in rows] == sorted(r.source for r in rows)
    assert (rows[0].email, rows[0].full_name, rows[1].full_name, rows[2].full_name) == ("b0@x.org", "Bob 0", "Ann\nof 1", "Second")
    assert "without" in caplog.text
    assert read_csvs(spark, [str(tmp_path / "none")]).count() == 0


def test_merging_a_large_cluster(raw):
    """Lists are united as rows; ten digits alike are one phone whatever their place."""
    many = [dict(record_ix=i, source=f"s{i % 3}.csv", full_name=f"N {i}", emails=[f"A{i % 7}@x.org", f"a{i % 7}@X.org"], skills_list=["SQL", "Go" if i % 2 else "Rust"]) for i in range(300)]
    m = M.merge(V.validate(raw(*many)).withColumn("cluster_id", F.lit(0))).collect()[0]
    assert m.emails == [f"a{i}@x.org" for i in range(7)] and m.n == 300
    assert m.skills == ["sql", "rust", "go"] and m.skill_sources == [["s0.csv", "s1.csv", "s2.csv"], ["s0.csv", "s2.csv", "s1.csv"], ["s1.csv", "s0.csv", "s2.csv"]]


def test_nothing_to_merge(raw):
    assert build_profiles(raw()).count() == 0


def test_counts_are_observed(spark):
    from rosterweave.plans.counters import observed

    df, seen = observed(spark.range(10), "run", even=F.when(F.col("id") % 2 == 0, 1))
    df.write.format("noop").mode("overwrite").save()
    assert seen.get == {"rows": 10, "even": 5}


def test_entries_of_a_large_record_do_not_carry_its_skills(spark):
    n = 1500
    rows = spark.range(n).selectExpr("named_struct('name', concat('s', id), 'confidence', 0.5 + id % 2 / 4, 'sources', array('a.csv')) s", "named_struct('field', 'skills', 'value', concat('s', id), 'source', 'a.csv', 'method', 'csv_direct') p")
    one = rows.groupBy().agg(F.collect_list("s").alias("skills"), F.collect_list("p").alias("provenance"))
    more = F.expr("array(named_struct('field', 'skills', 'value', 'odd', 'source', 'a.csv', 'method', 'm'), named_struct('field', 'emails', 'value', 's1', 'source', 'b.pdf', 'method', 'm'), named_struct('field', 'skills', 'value', cast(null as string), 'source', 'none', 'method', 'm'), named_struct('field', 'headline', 'value', cast(null as string), 'source', 'none', 'method', 'm'))")
    found = S.provenance_confidence(one.select(F.lit(7).alias("cluster_id"), "skills", F.concat("provenance", more).alias("provenance")))
    got = {(r.field, r.value): r.confidence for r in found.collect()}
    assert found.columns == ["cluster_id", "field", "value", "source", "method", "confidence"]
    assert len(got) == n + 4 and got["skills", "s1"] == 0.75 and got["skills", "s2"] == 0.5
    assert (got["skills", "odd"], got["emails", "s1"], got["skills", None], got["headline", None]) == (0.7, 0.85, 0.56, 0.0)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert all("map" not in line.lower() for line in plan.splitlines() if "Generate" in line or "Project" in line)


def test_names_of_a_crowded_phone_are_compared_in_blocks(spark, monkeypatch):
    """No table of grams is written, and blocks lose no pair, whatever the alphabet."""
    import random

    from rosterweave.functions.text import _lcs
    from rosterweave.storage import cut, figure

    near, written = __import__("rosterweave.operators.near", fromlist=["near"]), []
    monkeypatch.setattr(near, "BLOCK", 40)
    monkeypatch.setattr(near, "cut", lambda df, *a, **k: written.append(cut(df, *a, **k)) or written[-1])
    rng = random.Random(4)
    names = {"".join(rng.choice(["ko", "sha", "été", "mi", " ", "安", "ra", "s"]) for _ in range(8)).strip() for _ in range(150)} | {"a" * n for n in (1, 2, 40, 46, 300, 330)}
    names |= {n[:4] + n[5:] for n in sorted(names)[:60]} | {n[:3] + "x" + n[4:] for n in sorted(names)[:60]}
    rows = [(phone, n, i) for phone in ("+1", "+3") for i, n in enumerate(sorted(names - {""}))]
    got = [(r.na, r.nb, r.ia, r.ib, r.score) for r in near.near_names(cut(spark.createDataFrame(rows, "phone string, name string, ix long")), 85.0, 20).collect()]
    texts = rows[: len(rows) // 2]
    want = {(a, b, i, j, 200.0 * _lcs(a, b) / (len(a) + len(b))) for _, a, i in texts for _, b, j in texts if a < b and 200 * _lcs(a, b) / (len(a) + len(b)) >= 85}
    assert len(want) > 60 and len(got) == len(set(got)) and set(got) == want
    assert sum(figure(t, "rows") for t in written) == 2


def test_only_clusters_of_several_records_have_rows_for_their_values(raw):
    people = [dict(record_ix=i, source=s, full_name=f"N {i}", emails=[f"a{i}@x.org"], skills_list=["SQL", "Go"]) for i, s in ((1, "a.csv"), (2, "b.csv"), (3, "a.csv"), (4, None))]
    clustered = V.validate(raw(*people)).withColumn("cluster_id", F.when(F.col("record_ix") == 2, 1).otherwise(F.col("record_ix")).cast("long"))
    assert [r.cluster_id for r in M._list_values(clustered).collect()] == [1]
    got = {r.cluster_id: r for r in M.merge(clustered).collect()}
    assert {k: (r.n, r.emails, r.skills, r.skill_sources, r.merged_sources) for k, r in got.items()} == {
        1: (2, ["a1@x.org", "a2@x.org"], ["sql", "go"], [["a.csv", "b.csv"]] * 2, ["a.csv", "b.csv"]),
        3: (1, ["a3@x.org"], ["sql", "go"], [["a.csv"]] * 2, ["a.csv"]),
        4: (1, ["a4@x.org"], ["sql", "go"], [[None]] * 2, [None]),
    }


def test_sources_of_a_skill_are_read_once(spark):
    rows = spark.createDataFrame([(1, ["a.csv", "b.pdf", "a.csv"]), (2, ["a.csv", "B.CSV", "c.docx", "d"]), (3, []), (4, None), (5, [None])], "i int, s array<string>")
    found = rows.select("i", S.skill_confidence(F.col("s")).alias("c"))
    assert {r.i: r.c for r in found.collect()} == {1: 0.8325, 2: 0.8669, 3: 0.0, 4: 0.0, 5: 0.56}
    assert found._jdf.queryExecution().optimizedPlan().toString().count("array_distinct") == 1
