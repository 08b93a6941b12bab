from pyspark.sql import functions as F

from rosterweave.functions import extract as X
from rosterweave.sources.files import resume_records

TEXT = """Jane Q. Public
Mumbai, India
jane@x.org | +91 98765 43210 | https://www.linkedin.com/in/jane/
Senior Data Engineer
SKILLS
Languages: C
Python, AWS (Cloud), C; Docker
EXPERIENCE
Globex Inc
Data Engineer
Jan 2022 - Present
- built things
Acme Corp
2020-01 to 2021-06 Analyst
• counted
EDUCATION
Indian Institute of X, 85%
B.Tech, Computer Science 2015 - 2019 CGPA: 8.1
"""


def test_resume(spark):
    docs = spark.createDataFrame([(1, "r.txt", TEXT), (2, "e.txt", None), (3, "n.txt", "no sections at all")], "record_ix long, source string, text string")
    rows = {r.record_ix: r for r in resume_records(docs, F.lit("2023-01-15").cast("date"), 0).collect()}
    assert set(rows) == {1, 3}
    r = rows[1]
    assert (r.full_name, r.emails, r.location_city, r.location_country) == ("Jane Q. Public", ["jane@x.org"], "Mumbai", "India")
    assert r.linkedin == "https://www.linkedin.com/in/jane"
    assert r.headline == "Senior Data Engineer"
    assert r.skills_list == ["C", "Python", "AWS", "Docker"]  # behind a prefix a single letter survives, alone it does not
    assert [(e.company, e.title, e.start, e.end) for e in r.experience] == [("Globex Inc", "Data Engineer", "Jan 2022", None), ("Acme Corp", "Analyst", "2020-01", "2021-06")]
    assert r.experience[0].summary == "- built things"
    e = r.education[0]
    assert (e.institution, e.degree, e.field, e.cgpa, e.start_year, e.end_year) == ("Indian Institute of X,", "B.Tech", "Computer Science", "8.1", 2015, 2019)
    assert float(r.years_experience) == 2.4
    assert rows[3].experience == [] and rows[3].years_experience == "0.0"


def test_phones_keep_the_first_spelling(value):
    got = value(F.array_join(X.phones(F.col("x")), "|"), x="415-555-0101 or (415) 555-0101 or 98765 43210")
    assert got == "415-555-0101|98765 43210"


def test_last_of_repeated_sections_counts(value):
    assert value(X.section(F.col("x"), "SKILLS"), x="a\nSkills\none\nEDUCATION\nb\nskills\ntwo") == "two"
    assert value(X.section(F.col("x"), "HEADER"), x="a\nSkills\none") == "a"
