import random

import pytest

from hiretide import vocab
from hiretide.operators.tagging import add_role_category, add_techs
from hiretide.plans.fixture import with_texts


def tag(spark, rows, **options):
    df = with_texts(spark.createDataFrame(rows, "title string, description string"))
    out = add_techs(add_role_category(df), **options)
    return [(r["role_category"], r["techs"]) for r in out.collect()]


def test_first_rule_wins_and_labels_are_as_stored(spark):
    got = tag(spark, [("Backend Engineer / Data Engineer", ""), ("DEVOPS ENGINEER", None),
                      (None, "Data Engineer"), ("Office Manager", "")])
    assert [g[0] for g in got] == ["Backend Engineer", "Devops Engineer", "Other", "Other"]


def test_substrings_match_in_list_order(spark):
    text = "JavaScript, MongoDB, PostgreSQL, nodejs, Scalable"
    assert tag(spark, [(None, text)])[0][1] == ["sql", "postgres", "java", "node", "go", "scala"]


def test_title_counts_and_texts_do_not_run_together(spark):
    got = tag(spark, [("Kafka", ""), ("py", "thon"), (None, None)])
    assert [g[1] for g in got] == [["kafka"], [], []]


def test_listed_twice(spark):
    assert tag(spark, [("", "docker")])[0][1] == ["docker"]
    assert tag(spark, [("", "docker")], distinct=False)[0][1] == ["docker", "docker"]


def test_whole_words(spark):
    got = tag(spark, [("", "JavaScript and Go, C++ too"), ("", "java/go_lang c++11")],
              keywords=("java", "go", "c++"), match="word")
    assert [g[1] for g in got] == [["go", "c++"], ["java"]]


def test_bad_options(spark):
    with pytest.raises(ValueError):
        tag(spark, [("", "")], match="regex")
    with pytest.raises(ValueError):
        tag(spark, [("", "")], keywords=("a\nb",))


def test_no_keywords(spark):
    assert tag(spark, [("", "python")], keywords=())[0][1] == []


def test_own_rules(spark):
    df = with_texts(spark.createDataFrame([("Chief Cook",)], "title string")
                    .selectExpr("title", "title AS description"))
    out = add_role_category(df, rules=[("cook", "Kitchen")], default="None")
    assert out.first()["role_category"] == "Kitchen"


def test_against_brute_force(spark):
    rng = random.Random(5)
    words = list(vocab.TECH_KEYWORDS) + ["javascript", "Backend", "ENGINEER", "data", "scientist",
                                         "é", "İ", "mongodb", ", ", "\n", "devops engineer"]
    rows = [(None if rng.random() < .1 else " ".join(rng.choices(words, k=rng.randint(0, 5))),
             None if rng.random() < .1 else " ".join(rng.choices(words, k=rng.randint(0, 40))))
            for _ in range(400)]
    keywords = list(dict.fromkeys(vocab.TECH_KEYWORDS))
    wanted = []
    for title, text in rows:
        low, desc = (title or "").lower(), (text or "").lower()
        role = next((label for p, label in vocab.ROLE_RULES if p in low), "Other")
        wanted.append((role, [k for k in keywords if k in low or k in desc]))
    assert tag(spark, rows) == wanted
