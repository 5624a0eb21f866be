import math
import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from hiretide.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    text = text or ""
    own = WORD.findall(text)
    windows = {}
    for i in range(len(own) - 7):
        windows.setdefault(tuple(own[i:i + 8]), []).append(i)
    inside = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return {
        "n_words": len(own), "word_chars": sum(map(len, own)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text), "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(inside), "n_lines": len(lines),
        "n_echoes": sum(a == b for a, b in zip(own, own[1:])),
        "n_marks": sum(c in "!?" for c in text),
        "n_upper": sum("A" <= c <= "Z" for c in text),
        "n_cased": sum(c.isascii() and c.isalpha() for c in text)}


def measures(c):
    share = lambda a, b: c[a] / c[b] if c[b] else 0.0
    return {"symbol_share": share("n_symbols", "word_chars"), "mark_share": share("n_marks", "word_chars"),
            "upper_share": share("n_upper", "n_cased"), "echo_share": share("n_echoes", "n_words"),
            "dup_line_share": share("n_dup_lines", "n_lines"),
            "word_length": share("word_chars", "n_words")}


def verdicts(rows):
    """kept of (text, lang, source) rows, by sorting instead of sketches."""
    own = [(counts(t), g) for t, *g in rows]
    groups, wider = {}, {}
    for c, g in own:
        groups.setdefault(tuple(g), []).append(measures(c))
        wider.setdefault(g[0], []).append(measures(c))

    def quartile(rows, name, q):
        x = sorted(v[name] for v in rows)
        return x[math.ceil(q * len(x)) - 1]

    limits = {}
    for g, m in groups.items():
        for name, (_, _, below, above) in quality.MEASURES.items():
            low, middle, high = ((len(m) * quartile(m, name, q) + quality.LEAN * quartile(wider[g[0]], name, q))
                                 / (len(m) + quality.LEAN) for q in (0.25, 0.5, 0.75))
            reach = quality.FENCE / quality.QUARTILE
            limits[g, name] = (middle - (middle - low) * reach if below else None, max(
                middle + (high - middle) * reach, quality.FLOORS.get(name, 0.0)) if above else None)
    out = []
    for c, g in own:
        m = measures(c)
        base = c["n_words"] < 20 or 100 * c["n_repeat_words"] > 30 * c["n_words"]
        beyond = False
        for name, (_, whole, _, _) in quality.MEASURES.items():
            low, high = limits[tuple(g), name]
            if c[whole]:
                beyond |= low is not None and m[name] < low - quality.CHANCE * math.sqrt(max(low, 0) / c[whole])
                beyond |= high is not None and m[name] > high + quality.CHANCE * math.sqrt(max(high, 0) / c[whole])
        out.append((base, not base and not beyond))
    return out


@settings(deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(st.sampled_from("ab \n\t!#Zé漢\x1c"), max_size=60)),
                max_size=6))
def test_counts(texts):
    got = quality.measure(pa.array(texts, pa.string()))
    for i, text in enumerate(texts):
        assert {k: int(v[i]) for k, v in got.items()} == counts(text)


def test_repeated_windows_overlap():
    text = " ".join(["a b c d e f g h i"] * 3 + ["x y z"])
    assert quality.measure(pa.array([text]))["n_repeat_words"][0] == counts(text)["n_repeat_words"]


def test_verdicts_over_documents(spark, docs):
    for frame in (docs, spark.read.parquet("/root/testdata/sf0.01/documents.parquet")):
        rows = frame.select("doc_id", "text", "lang", "source").collect()
        wanted = {r.doc_id: v for r, v in zip(rows, verdicts([r[1:] for r in rows]))}
        judged = quality.judge(frame).collect()
        assert {r.doc_id: (r.base_failed, r.kept) for r in judged} == wanted
        kept = quality.keep_good(frame)
        assert sorted(kept.collect()) == sorted(
            r for r in frame.collect() if wanted[r.doc_id][1])


def test_junk_is_rejected_and_good_text_kept(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = quality.judge(docs).join(labels, "doc_id").select("quality", "kept", "base_failed").collect()
    junk = [r.kept for r in rows if r.quality == 0]
    good = [r.kept for r in rows if r.quality == 1 and not r.base_failed]
    assert np.mean(junk) < 0.02 and np.mean(good) > 0.995


def test_most_fences_are_the_sketches_own(spark):
    """Of seven fences a group four come from its sketch alone: these differ from group to group."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    rows = quality.thresholds(quality.with_measures(quality.quality_counts(docs))).collect()
    assert len(rows) > 50
    for side in ("upper_share_high", "echo_share_high", "word_length_low", "word_length_high"):
        assert len({getattr(r, side) for r in rows}) > 0.9 * len(rows)
    floored = [getattr(r, f"{m}_high") == floor for r in rows for m, floor in quality.FLOORS.items()]
    assert np.mean(floored) > 0.5  # and these three stand, in most groups, on their floors


def test_a_fence_moves_with_its_group(spark):
    """Long words fail among short ones, and are kept in a source that has them."""
    def text(size, seed):
        return " ".join("x" * (size + (i * 7 + seed) % 3) for i in range(400))

    rows = [(i, text(4, i), "en", "short") for i in range(200)] + [
        (1000 + i, text(14, i), "en", "long") for i in range(200)] + [(5000, text(14, 1), "en", "short")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id: r.kept for r in quality.judge(df).collect()}
    base = {r.doc_id for r in quality.judge(df).collect() if r.base_failed}
    limits = {r.source: r for r in quality.thresholds(quality.with_measures(quality.quality_counts(df))).collect()}
    assert limits["long"].word_length_high > limits["short"].word_length_high + 3
    assert base or (not kept[5000] and all(kept[i] for i in [*range(200), *range(1000, 1200)]))


def test_small_groups_lean_on_their_language(spark):
    rows = [(i, " ".join("x" * (3 + (i + j % 2) % 5) for j in range(300)), "en", "big") for i in range(300)] + [
        (900, " ".join("y" * 5 for _ in range(300)), "en", "one")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    limits = {r.source: r for r in quality.thresholds(quality.with_measures(quality.quality_counts(df))).collect()}
    assert limits["one"].word_length_high > 5.0 and limits["one"].word_length_low < 5.0


def test_edges(edge_docs, no_docs):
    judged = quality.judge(edge_docs).collect()
    assert len(judged) == edge_docs.count()
    assert {r.kept for r in judged if r.doc_id in (2, 3, 4)} == {False}
    kept = quality.keep_good(edge_docs)
    assert kept.columns == edge_docs.columns and kept.count() <= edge_docs.count()
    assert quality.judge(no_docs).collect() == [] and quality.keep_good(no_docs).collect() == []
