import math
import random
import re
import tempfile

from lexrev.operators import textmodel as TM
from lexrev.plans import review as RV
from lexrev.plans.run import review_corpus


def corpus():
    rnd = random.Random(2)
    good, bad = [f"good{i}" for i in range(20)] + ["the"], [f"bad{i}" for i in range(20)] + ["the", "É"]
    rows = [(i, " ".join(rnd.choices(good if i % 3 else bad, k=rnd.randint(3, 25)))) for i in range(90)] + [(200, None), (201, ""), (202, "unseen words only")]
    return rows, {i: "a" if i % 3 else "b" for i, _ in rows if i % 2 == 0}


def grams(t):
    w = re.findall(r"[^\W]{2,}", (t or "").lower())
    return [" ".join(w[i:i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def brute(rows, labels, alpha=0.1, features=5000):
    train = {i: grams(t) for i, t in rows if i in labels}
    n = len(train)
    df, total = {}, {}
    for g in train.values():
        for x in set(g):
            df[x] = df.get(x, 0) + 1
            total[x] = total.get(x, 0) + g.count(x)
    vocab = sorted((x for x in df if 2 <= df[x] <= 0.95 * n), key=lambda x: (-total[x], x))[:features]
    idf = {x: math.log((1 + n) / (1 + df[x])) + 1 for x in vocab}

    def vector(g):
        v = {x: g.count(x) * idf[x] for x in set(g) if x in idf}
        norm = math.sqrt(sum(y * y for y in v.values()))
        return {x: y / norm for x, y in v.items()}

    sums = {c: {} for c in set(labels.values())}
    for i, g in train.items():
        for x, y in vector(g).items():
            sums[labels[i]][x] = sums[labels[i]].get(x, 0) + y
    out = {}
    for i, t in rows:
        v = vector(grams(t))
        scores = {c: math.log(sum(k == c for k in labels.values()) / n) + sum(
            y * math.log((s.get(x, 0) + alpha) / (sum(s.values()) + alpha * len(vocab))) for x, y in v.items()) for c, s in sums.items()}
        best = min(scores, key=lambda c: (-scores[c], c))
        out[i] = (best, 1 / sum(math.exp(x - scores[best]) for x in scores.values()))
    return out, idf


def test_model_against_plain_python(spark, tmp_path):
    rows, labels = corpus()
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, term string")
    lab = spark.createDataFrame([*labels.items(), (None, "a"), (9999, "b"), (8, None)][:-1], "doc_id long, label string")
    for features in (None, 40):
        model = TM.fit_bayes(docs, lab, max_features=features)
        want, idf = brute(rows, labels, features=features or 5000)
        assert {r.term: round(r.idf, 9) for r in model.terms.collect()} == {x: round(v, 9) for x, v in idf.items()}
        got = {r.doc_id: (r.label, r.probability) for r in TM.score_bayes(model, docs).collect()}
        assert {i: g[0] for i, g in got.items()} == {i: w[0] for i, w in want.items()}
        assert all(abs(got[i][1] - want[i][1]) < 1e-9 for i in want)
    model.save(str(tmp_path / "m"))
    again = TM.load_bayes(spark, str(tmp_path / "m"))
    assert sorted(map(tuple, TM.score_bayes(again, docs).collect())) == sorted(map(tuple, TM.score_bayes(model, docs).collect()))


def test_repeated_keys_and_labels(spark, monkeypatch):
    """Documents of several rows are one, a document with several labels counts with each."""
    rnd = random.Random(5)
    words = [f"w{i:02}" for i in range(12)]
    rows = [(i % 35 if i < 60 else i, " ".join(rnd.choices(words, weights=range(1, 13), k=rnd.randint(0, 12)))) for i in range(90)]
    labels = [(i, "a" if i % 3 else "b") for i in range(90)] + [(i, rnd.choice("abc")) for i in (1, 2, 2, 61, 62)] + [(None, "a")]
    docs = spark.createDataFrame([*rows, (None, "w01 w02")], "doc_id long, text string")
    lab = spark.createDataFrame(labels, "doc_id long, label string")
    counts, of = {}, {}
    for i, name in labels:
        of.setdefault(i, []).append(name)
    for i, t in rows:
        own = counts.setdefault(i, {})
        for g in grams(t):
            own[g] = own.get(g, 0) + len(of[i])
    total, df = {}, {}
    for i, own in counts.items():
        for g, tf in own.items():
            total[g] = total.get(g, 0) + tf * len(of[i])
            df[g] = df.get(g, 0) + len(of[i])
    n = len(counts)
    vocab = sorted((g for g in df if 2 <= df[g] <= 0.95 * n), key=lambda g: (-total[g], g))[:30]
    idf = {g: math.log((1 + n) / (1 + df[g])) + 1 for g in vocab}
    sums = {}
    for i, own in counts.items():
        w = {g: tf * idf[g] for g, tf in own.items() if g in idf}
        norm = math.sqrt(len(of[i]) * sum(x * x for x in w.values()))
        for name in of[i]:
            for g, x in w.items():
                sums[g, name] = sums.get((g, name), 0) + x / norm
    want = {(g, name): round(math.log((s + 0.1) / 0.1), 9) for (g, name), s in sums.items()}
    for most in (TM.MAX_FREQUENT, 3):  # 3: all runs are counted
        monkeypatch.setattr(TM, "MAX_FREQUENT", most)
        model = TM.fit_bayes(docs, lab, max_features=30)
        terms = model.terms.collect()
        assert {r.term: round(r.idf, 9) for r in terms} == {g: round(x, 9) for g, x in idf.items()}
        assert {(r.term, name): round(d, 9) for r in terms for name, d in r.deltas.items()} == want
    got = {r.doc_id: (r.label, r.probability) for r in TM.score_bayes(model, docs).collect()}
    merged = spark.createDataFrame([(i, " . ".join(t for j, t in [*rows, (None, "w01 w02")] if j == i)) for i in got], "doc_id long, text string")
    one = {r.doc_id: r.label for r in TM.score_bayes(model, merged.where("doc_id >= 60 OR doc_id IS NULL")).collect()}
    assert len(got) == n + 1 and all(got[i][0] == label for i, label in one.items())


def test_only_runs_of_frequent_words_are_counted(spark):
    rnd = random.Random(6)
    texts = [["the", "of"] * 30 + rnd.choices([f"rare{i}" for i in range(500)], k=40) + rnd.choices(["and", "to"], k=30) for _ in range(50)]
    lists = spark.createDataFrame([(t,) for t in texts], "_w array<string>")
    df, total = {}, {}
    for t in texts:
        own = grams(" ".join(t))
        for g in own:
            total[g] = total.get(g, 0) + 1
        for g in set(own):
            df[g] = df.get(g, 0) + 1
    for size in (10, 100, 5000):
        want = sorted(((g, df[g], total[g]) for g in df if 2 <= df[g] <= 0.95 * 50), key=lambda r: (-r[2], r[0]))[:size]
        assert TM.vocabulary_runs(lists, 50, size=size) == want
    pairs = TM._longer_runs(lists, TM.Runs(["the", "of", "and", "to"])).groupBy("term").sum("total").collect()
    assert {r[0]: r[1] for r in pairs} == {g: c for g, c in total.items() if len(g.split()) == 2 and "rare" not in g}


def test_saved_model_in_the_job(spark, tmp_path):
    docs = spark.createDataFrame([(i, ("board meeting of shareholders " if i % 2 else "lottery winner click here ") * 3, "s") for i in range(20)],
                                 "doc_id long, text string, source string")
    model = TM.fit_bayes(docs, docs.selectExpr("doc_id", "CASE WHEN doc_id % 2 = 1 THEN 'board_resolution' ELSE 'spam' END AS label"))
    model.save(str(tmp_path / "m"))
    out = tempfile.mkdtemp(prefix="lexrev-ml-")
    paths = review_corpus(spark, docs, out, method="ml", model=str(tmp_path / "m"))
    types = {r.doc_id: r.report.classification for r in spark.read.parquet(paths["documents"]).collect()}
    assert all(c.predicted_type == ("board_resolution" if i % 2 else "spam") and c.method_used == "ml" and c.confidence > 0.5 for i, c in types.items())
    plain = RV.reviewed(docs, method="ml").select("method_used").distinct().collect()
    assert [r.method_used for r in plain] == ["rule_based"]


def test_filter_on_evidence_does_not_carry_the_scoring(spark, docs, monkeypatch):
    from lexrev.plans import catalog as Q

    written, cut = {}, Q.cut_lineage
    monkeypatch.setattr(Q, "cut_lineage", lambda df, name: written.update({name: df}) or cut(df, name))
    texts = ["Articles of Association, share capital, board of directors", "nothing", "ultimate beneficial owner", "Articles of Association"]
    model = Q._type_model(spark, docs(*texts))
    plan = written["rule-types"]._jdf.queryExecution().optimizedPlan().toString()
    assert all("raw_score" not in line for line in plan.splitlines() if "Filter" in line)
    assert {name for name, _, _ in model.labels} == {r.predicted_type for r in written["rule-types"].collect() if r.has_evidence}
