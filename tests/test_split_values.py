import pytest

from rosterweave.operators.split_values import split_values

CASES = [
    ("Python, SQL; Go", ["Python", "SQL", "Go"]),
    ('"Sales, B2B",Rust', ["Sales, B2B", "Rust"]),
    ('"the ""old"" stack" | C#', ['the "old" stack', "C#"]),
    ("“Cutting; grinding”\tGit", ["Cutting; grinding", "Git"]),
    ("'Word, Excel, Outlook' · Java's future", ["Word, Excel, Outlook", "Java's future"]),
    ("AWS (EC2, S3), CI/CD / Docker", ["AWS (EC2, S3)", "CI/CD", "Docker"]),
    ('["Git", "gRPC "]', ["Git", "gRPC"]),
    ("1. React\n2. SQL", ["React", "SQL"]),
    ("- Java\n- Linux\n", ["Java", "Linux"]),
    ("• Rust • Go•", ["Rust", "Go"]),
    ("K8, Go and Rust,", ["K8", "Go", "Rust"]),
    ('Go and "Sales and Care"', ["Go", "Sales and Care"]),
    (", ;, Rust,,", ["Rust"]),
    ("Payroll - 7 yrs, Search-Engine-Optimization", ["Payroll - 7 yrs", "Search-Engine-Optimization"]),
    ('"open, Rust', ['"open', "Rust"]),
    ("R&D", ["R&D"]),
    ("   ", []),
    ("", []),
    (None, []),
]


def test_cases(spark):
    rows = split_values(spark.createDataFrame([(i, t, "x") for i, (t, _) in enumerate(CASES)], "id long, text string, pos string"), "id", "text").collect()
    for i, (text, want) in enumerate(CASES):
        got = sorted((r.pos, r.skill_value) for r in rows if r.id == i)
        assert [v for _, v in got] == want, text
        assert [p for p, _ in got] == list(range(1, len(want) + 1))


def test_long_text_and_repeats(spark):
    text = ",".join(f"v{i}" for i in range(5000))
    rows = split_values(spark.createDataFrame([(1, text), (2, "a,b"), (2, "a,b")], "id long, text string"), "id", "text")
    assert rows.where("id = 1").count() == 5000
    assert rows.where("id = 2").count() == 4


@pytest.mark.parametrize("how", ["left", "inner"])
def test_lookup_joins_agree(spark, how):
    from rosterweave.operators.joins import lookup_join

    rows = spark.createDataFrame([(i, None if i % 7 == 0 else "a" if i % 3 else f"k{i}") for i in range(300)], "id long, k string")
    table = rows.where("k is not null and id % 2 = 0").select("k").distinct().selectExpr("k", "length(k) as n")
    show = lambda df: sorted(map(repr, df.select("id", "k", "n").collect()))
    want = show(rows.join(table, "k", how))
    assert show(lookup_join(rows, table, ["k"], how)) == want
    assert show(lookup_join(rows, table, ["k"], how, limit=0)) == want
    assert show(lookup_join(rows, table, ["k"], how, limit=0, hot_rows=20)) == want


@pytest.mark.parametrize("schema", ["id long, text string"])
def test_empty_table(spark, schema):
    assert split_values(spark.createDataFrame([], schema), "id", "text").count() == 0
