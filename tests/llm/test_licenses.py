from hiretide.llm import licenses


def dice(a, b):
    a, b = set(licenses.template_bigrams(a)), set(licenses.template_bigrams(b))
    return 2 * len(a & b) / (len(a) + len(b)) if a and b else 0.0


def found(spark, text):
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    return [(f["kind"], f["license"]) for f in licenses.find_licenses(df).first().found]


def test_notices_are_found_in_lines(spark):
    text = ("Some text.\nReleased under the MIT license\nmore\nThis work is licensed under the GNU "
            "General Public License, version 3.")
    assert found(spark, text) == [("line", "mit"), ("line", "gpl-3.0")]
    assert found(spark, "we saw the license of the dog") == []


def test_a_notice_over_several_lines_is_a_paragraph(spark):
    mit = dict((t[:10], t) for _, t in licenses.TEMPLATES)["Permission"]
    lines = mit.replace(", free", ",\nfree").replace("use, copy", "use,\n copy")
    assert ("paragraph", "mit") in found(spark, "intro\n\n" + lines + "\n\nrest")


def test_best_template_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = {r.doc_id: r.found for r in licenses.find_licenses(docs).collect()}
    hits = 0
    for r in docs.collect():
        lines = [(i, max((dice(x, t), name) for name, t in licenses.TEMPLATES))
                 for i, x in enumerate(r.text.split("\n")) if len(x) < 2000]
        wanted = [(i, name, d) for i, (d, name) in lines if 100 * d >= licenses.LEAST_PCT]
        got = [(f["place"], f["license"], f["dice"]) for f in rows[r.doc_id] if f["kind"] == "line"]
        assert got == wanted
        hits += len(got)
    assert hits > 10


def test_edges(edge_docs, no_docs):
    rows = licenses.find_licenses(edge_docs).collect()
    assert len(rows) == edge_docs.count() and all(r.found == [] for r in rows)
    assert licenses.find_licenses(no_docs).collect() == []
