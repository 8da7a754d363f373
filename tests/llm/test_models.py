"""Secret scan, perplexity, toxicity and the pipeline against plain Python or held-out accuracy."""

import hashlib
import math
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from tests.llm.fixtures import as_sf_dir, awkward, awkward_rows, empty, labels, prose, table
from wirelake.llm import perplexity, secret_scan, toxicity
from wirelake.llm.common import read_table
from wirelake.llm.queries import llm_queries
from wirelake.session import shared_dir

SF = "/root/testdata/sf0.01"


def plain_base(text: str) -> list:
    found = []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A):
        if len(m.group(2)) >= 12:
            found.append((m.start(2), 0, "assign", m.end(2)))
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m.group()) >= 18]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m.group()) >= 16]
    return sorted(found)


def secret_texts() -> list[str]:
    rng, out = random.Random(2), []
    for k in range(120):
        words = [w + str(rng.randrange(99)) if rng.random() < 0.1 else w for w in prose(60, 2000 + k).split()]
        if k % 2:
            value = "".join(rng.choice("0123456789abcdef") for _ in range(40))
            words[rng.randrange(60)] = rng.choice([f'token = "{value}"', f"api_key: {value}", f"PassWord='{value}'", "AKIA" + value.upper()[:16], value, f"token=password: {value}"])
        out.append(" ".join(words))
    return out + ["token = short", "secret=", "AKIA" + "Z" * 13, "AKIA" + "Z" * 14, "ſecret: abcdefghijklmnop", "é" * 40 + " 0123456789abcdef", "toKen\":\"aaaabbbbcccc"]


def test_base_spans():
    for text in secret_texts() + [r[1] or "" for r in awkward_rows()]:
        assert [(a, k, b) for a, k, b in secret_scan.base_spans(text)] == [(a, k, b) for a, k, _, b in plain_base(text)]


def test_secret_query(spark, scratch):
    docs = table(spark, [(k, t, "en", "s") for k, t in enumerate(secret_texts())] + [(1000 + k, *r[1:]) for k, r in enumerate(awkward_rows())])
    folder = as_sf_dir(spark, docs, labels(spark), f"{scratch}/sf")
    got = {r.doc_id: r for r in llm_queries()["op2_secret_scan"](spark, folder).collect()}
    for r in docs.collect():
        base = plain_base(r.text or "")
        listed = ",".join(f"{name}:{a}:{b}" for a, _, name, b in base)
        g = got[r.doc_id]
        assert (g.n_assign, g.n_access, g.n_hex) == tuple(sum(x[2] == n for x in base) for n in ("assign", "access", "hex"))
        assert g.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        spans = [s for s in g.spans.split(",") if s]
        assert [s for s in spans if not s.startswith("crf")] == [s for s in listed.split(",") if s] and len(spans) - len(base) == g.n_crf
        assert spans == sorted(spans, key=lambda s: (int(s.split(":")[1]), ["assign", "access", "hex", "crf"].index(s.split(":")[0])))
    assert secret_scan.find_secrets(empty(spark), secret_scan.train(empty(spark))).count() == 0


def test_field_finds_more_and_leaves_prose_alone(spark):
    docs = table(spark, [(k, t, "en", "s") for k, t in enumerate(secret_texts())])
    field = secret_scan.train(docs)
    value = "ghp_" + "16C7e42F292c6912E7710c838347Ae178B4a"
    spans = secret_scan.scan([f"alpha beta gamma {value} delta eta", prose(200, 1), ""], field)
    assert [(17, 3, 17 + len(value))] == spans[0] and spans[1] == spans[2] == []


def test_field_is_trained_however_rare_its_examples_are(spark, monkeypatch):
    """One document in a thousand holds a secret: half of the sample are such documents."""
    monkeypatch.setattr(secret_scan, "SAMPLE", 40)
    rows = [(k, f"words about number {k} " + (f"password = Zx{k}qwErTy{k}99" if k % 1000 == 7 else "and more of them"), "en", "s") for k in range(4000)]
    assert secret_scan.train(table(spark, rows)) is not None
    assert secret_scan.train(table(spark, [r for r in rows if r[0] % 1000 != 7])) is None


def test_viterbi_is_exact():
    tokens = secret_scan.tokenise([prose(30, 1), "", "one", prose(7, 2), "a  b\tc " * 9])
    first = np.concatenate([[True], tokens.text[1:] != tokens.text[:-1]])
    for seed in range(12):
        rng = np.random.default_rng(seed)
        field = secret_scan.Field(rng.normal(size=(secret_scan.WIDTH, 3)) + np.array([seed / 2, 0, 0]), rng.normal(size=(3, 3)), rng.normal(size=3))
        score, tags = field.emissions(tokens.features), field.tags(tokens)
        for k in np.unique(tokens.text):
            at = np.flatnonzero(tokens.text == k)
            best, back = field.first + score[at[0]], []
            for t in at[1:]:
                via = best[:, None] + field.transitions
                back.append(via.argmax(axis=0))
                best = via.max(axis=0) + score[t]
            path = [int(best.argmax())]
            for b in reversed(back):
                path.append(int(b[path[-1]]))
            assert tags[at].tolist() == path[::-1]
    assert first.sum() == 4


def plain_kneser_ney(trusted: list[str], order: int):
    """Interpolated modified Kneser-Ney by the book, with the operator's rule for discounts that can't be told."""
    pad = perplexity.START * (order - 1)
    counts = {order: Counter()}
    for t in trusted:
        s = pad + t + perplexity.END
        counts[order].update(s[k : k + order] for k in range(len(s) - order + 1))
    for n in range(order - 1, 0, -1):
        counts[n] = Counter(g[1:] for g in counts[n + 1])
    discounts, totals, kinds = {}, {}, {}
    for n, level in counts.items():
        c = Counter(min(v, 4) for v in level.values())
        y = c[1] / max(c[1] + 2 * c[2], 1)
        raw = {k: k - (k + 1) * y * c[k + 1] / max(c[k], 1) for k in (1, 2, 3)}
        discounts[n] = {k: raw[k] if c[k] and 0 < raw[k] <= k else (0.5 if k == 1 else 0.75) for k in raw}
        totals[n], kinds[n] = Counter(), defaultdict(Counter)
        for g, v in level.items():
            totals[n][g[:-1]] += v
            kinds[n][g[:-1]][min(v, 3)] += 1

    def p(gram: str) -> float:
        n = len(gram)
        lower = p(gram[1:]) if n > 1 else 1 / (len(counts[1]) + 1)
        total = totals[n][gram[:-1]]
        if not total:
            return lower
        v = counts[n][gram]
        share = (v - discounts[n][min(v, 3)]) / total if v else 0.0
        return share + sum(discounts[n][k] * x for k, x in kinds[n][gram[:-1]].items()) / total * lower

    def score(t: str) -> float:
        s = pad + t + perplexity.END
        logs = [math.log(p(s[k : k + order])) for k in range(len(s) - order + 1)]
        return math.exp(-sum(logs) / len(logs))

    return p, score


def test_answers_move_packed_by_block(spark, monkeypatch):
    """The tasks that join n-grams with their probabilities pack them, so the shuffle by block moves few rows, not one per n-gram."""
    plans, write = {}, perplexity.materialise
    monkeypatch.setattr(perplexity, "materialise", lambda df, purpose: plans.update({purpose: df._jdf.queryExecution().sparkPlan().toString()}) or write(df, purpose))
    docs = table(spark, [(k, prose(40, k), ("en", "fr", None)[k % 3], "s") for k in range(60)])
    assert perplexity.perplexities(docs, spark.range(30).toDF("id")).count() == 60
    nodes = [line.strip(" :+-") for line in plans["kn-answers"].splitlines()]
    assert nodes[0].startswith("FlatMapGroupsInArrow") and any(n.startswith("MapInArrow") for n in nodes[1:])


def test_gathered_answers_come_back(monkeypatch):
    monkeypatch.setattr(perplexity, "GATHERED", 50)
    rng = np.random.default_rng(1)
    rows = [(b, at, float(np.float32(rng.normal()))) for b in (3, 0, 2**40) for at in rng.choice(1000, 70, replace=False).tolist()]
    rows = [rows[k] for k in rng.permutation(len(rows))] + [(7, 0, -0.5), (7, 2**31 - 1, -1.5)]
    batches = [pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[k : k + 20]), (pa.int64(), pa.int32(), pa.float32()))], ["block", "at", "logp"]) for k in range(0, len(rows), 20)]
    got = Counter()
    for out in perplexity._gathered(iter(batches)):
        for block, n, packed in zip(*(c.to_pylist() for c in out.columns)):
            at, logp = perplexity._spread(n, packed)
            assert (np.diff(at) > 0).all()
            got.update((block, int(a), float(x)) for a, x in zip(at, logp))
    assert got == Counter(rows) and list(perplexity._gathered(iter([]))) == []


def test_perplexity(spark):
    rows = awkward_rows()
    trusted = {100 + k for k in range(0, 30, 2)} | {10, 8}
    docs = awkward(spark)
    ids = spark.createDataFrame([(i,) for i in trusted], "id long")
    got = Counter((r.id, r.lang, None if r.perplexity is None else round(r.perplexity, 3)) for r in perplexity.perplexities(docs, ids).collect())
    by_lang = {lang: plain_kneser_ney([r[1] for r in rows if r[0] in trusted and r[2] == lang and r[1]], perplexity.ORDER)[1] for lang in {r[2] for r in rows if r[0] in trusted}}
    want = Counter()
    for r in rows:
        known = r[2] in by_lang and bool(r[1])
        want[r[0], r[2], round(by_lang[r[2]](r[1]), 3) if known else None] += 1
    close = lambda c: sorted((str(i), str(lang), p is None, p or 0.0) for (i, lang, p), n in c.items() for _ in range(n))
    for a, b in zip(close(got), close(want), strict=True):
        assert a[:3] == b[:3] and abs(a[3] - b[3]) <= 2e-3 * max(1.0, b[3])


def test_probabilities_sum_to_one():
    p, _ = plain_kneser_ney([prose(50, k) for k in range(4)], 3)
    chars = {c for k in range(4) for c in prose(50, k)} | {perplexity.END}
    assert abs(sum(p("al" + c) for c in chars) + p("al\x7f") - 1) < 1e-9


def test_quality_keeps_prose_and_drops_junk(spark):
    rows = [(k, prose(80, k), "en", "s") for k in range(120)]
    rows += [(500 + k, "".join(random.Random(k).choice("#$%&*!~^qzjx") for _ in range(300)), "en", "s") for k in range(10)]
    marks = labels(spark, [(k, 1, 0) for k in range(60)] + [(500, 0, 0)])
    got = {r.doc_id: r.keep for r in perplexity.quality(table(spark, rows), marks).collect()}
    assert sum(got[k] for k in range(120)) >= 117 and not any(got[500 + k] for k in range(10))
    awk = perplexity.quality(awkward(spark), labels(spark, [(100 + k, 1, 0) for k in range(30)])).collect()
    keep = {r.doc_id: r.keep for r in awk}
    assert len(awk) == len(awkward_rows()) and keep[3] is keep[4] is False and keep[2**62] is True  # empty; a language without trusted text
    assert perplexity.quality(empty(spark), labels(spark)).count() == 0
    assert perplexity.quality(awkward(spark), labels(spark)).count() == len(awkward_rows())


def test_quality_threshold_is_a_tight_quantile(spark):
    """The 0.95 quantile of the held-out trusted texts, but for an allowance of 1/n, which rejects a repeated word."""
    rows = [(k, prose(80, k), "en", "s") for k in range(300)] + [(900 + k, " ".join(["Oure"] * 80), "en", "s") for k in range(3)]
    got = perplexity.quality(table(spark, rows), labels(spark, [(k, 1, 0) for k in range(300)]))
    got = got.selectExpr("*", f"pmod(xxhash64(doc_id), {perplexity.HELD_OUT_OF}) = 0 AS held").collect()
    held = sorted(r.perplexity for r in got if r.doc_id < 300 and r.held)
    limit = held[math.ceil(0.95 * len(held)) - 1] * (1 + 1 / len(held))
    assert len(held) > 30 and all(abs(r.threshold - limit) < 1e-9 for r in got) and not any(r.keep for r in got if r.doc_id >= 900)


def test_distinct_grams_over_slices():
    """Slices added one by one give every n-gram once, in the order of hashes, with its count in the counted ones."""
    slices = [([prose(40, k), "", "é日本語" * k, "a\0b"], k % 2 == 0) for k in range(5)]
    found, want = perplexity._Distinct(), Counter()
    for texts, counted in slices:
        found.add(texts, counted)
        for t in texts:
            s = perplexity.START * (perplexity.ORDER - 1) + t.replace("\0", perplexity.NUL) + perplexity.END
            for k in range(len(t) + 1):
                want[s[k : k + perplexity.ORDER]] += counted
    assert dict(zip(found.grams.tolist(), found.counts.tolist())) == dict(want) and len(found.grams) == len(want)
    assert (np.diff(found.hashes.astype(object)) > 0).all()


def test_scoring_leaves_no_tables_of_grams(spark):
    """Before the texts move again the n-grams and the model are dropped, or their files stand beside the texts' shuffle."""
    folder = os.path.dirname(shared_dir(spark, "kn"))
    base = folder.removeprefix("file:")
    tables = lambda: {n for n in os.listdir(base) if n.startswith("kn-")} if os.path.isdir(base) else set()
    before = tables()
    scored = perplexity.perplexities(awkward(spark), spark.createDataFrame([(100 + k,) for k in range(30)], "id long"))
    assert {n.rsplit("-", 1)[0] for n in tables() - before} == {"kn-answers"} and scored.count() == len(awkward_rows())


def test_toxicity_held_out(spark):
    docs, marks = read_table(spark, SF, "documents"), read_table(spark, SF, "labels")
    got = toxicity.score(docs, toxicity.train(docs, marks)).toPandas().merge(marks.toPandas(), on="doc_id", how="left")
    assert len(got) == docs.count() and (got.held_out == [zlib.crc32(str(i).encode()) % 3 == 1 for i in got.doc_id]).all()
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.7)).all()
    test = got[got.held_out & got.toxic.notna()]
    toxic, clean = test[test.toxic == 1], test[test.toxic == 0]
    wins = (toxic.score.to_numpy()[:, None] > clean.score.to_numpy()).mean() + 0.5 * (toxic.score.to_numpy()[:, None] == clean.score.to_numpy()).mean()
    assert wins > 0.93 and toxic.predicted.mean() > 0.7 and clean.predicted.mean() < 0.05


def test_toxicity_ignores_held_out_labels_and_other_columns(spark):
    docs, marks = read_table(spark, SF, "documents"), read_table(spark, SF, "labels")
    turned = marks.selectExpr("doc_id", "quality", "IF(crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 3 = 1, 1 - toxic, toxic) AS toxic")
    other = docs.selectExpr("doc_id", "text", "'xx' AS lang", "'yy' AS source")
    a, b = (toxicity.score(d, toxicity.train(d, m)).orderBy("doc_id").collect() for d, m in ((docs, marks), (other, turned)))
    assert a == b


def test_non_negative_risk():
    """With positives hidden among the unlabelled, the fit still ranks them above the rest."""
    rng = np.random.default_rng(1)
    pos, unl = rng.normal(1.0, 1.0, (300, 5)), np.concatenate([rng.normal(1.0, 1.0, (200, 5)), rng.normal(-1.0, 1.0, (800, 5))])
    w, b = toxicity.fit_nnpu(pos, unl, 0.2)
    z = unl @ w + b
    assert (z[:200, None] > z[200:]).mean() > 0.97 and 0.1 < (z > 0).mean() < 0.3


def plain_nnpu(pos, unl, prior, steps, rate, decay):
    """The non-negative risk, followed downhill by Adam, one number at a time."""
    import math

    n = len(pos[0])
    w = [0.0] * n + [math.log(prior / (1 - prior))]
    m, v = [0.0] * (n + 1), [0.0] * (n + 1)
    logit = lambda x: sum(a * b for a, b in zip(x, w)) + w[n]
    sigmoid = lambda z: 1 / (1 + math.exp(-z))
    for step in range(1, steps + 1):
        negative = sum(math.log1p(math.exp(logit(x))) for x in unl) / len(unl) - prior * sum(math.log1p(math.exp(logit(x))) for x in pos) / len(pos)
        grad = [decay * prior * a for a in w[:n]] + [0.0]
        for rows, side in ((pos, True), (unl, False)):
            for x in rows:
                s = sigmoid(logit(x))
                slope = -prior * s / len(pos) if side else s / len(unl)  # of the negative part
                slope = (slope + (prior * (s - 1) / len(pos) if side else 0.0)) if negative >= 0 else -slope
                for k in range(n):
                    grad[k] += slope * x[k]
                grad[n] += slope
        for k in range(n + 1):
            m[k], v[k] = 0.9 * m[k] + 0.1 * grad[k], 0.999 * v[k] + 0.001 * grad[k] ** 2
            w[k] -= rate * (m[k] / (1 - 0.9**step)) / (math.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return w


@pytest.mark.parametrize("prior", [0.3, 0.001])
def test_fit_against_plain_python(prior):
    rng = np.random.default_rng(4)
    pos, unl = rng.random((7, 3)) + [0.5, 0, 0], rng.random((11, 3))
    w, b = toxicity.fit_nnpu(pos, unl, prior, steps=60, rate=0.05, decay=2e-4)
    assert np.allclose([*w, b], plain_nnpu(pos.tolist(), unl.tolist(), prior, 60, 0.05, 2e-4), atol=1e-9)


def test_score_against_plain_python():
    """A score is the logistic of the bias, the weights of the hashes that occur, and their densities."""
    import math

    texts = ["bad bad words here", "", "nothing of note", "bad " * 700 + "good"]
    doc, feature, count, words = toxicity.word_features(texts)
    some = np.unique(feature[doc == 0])[:5]
    model = toxicity.Model(some, np.linspace(-1, 1, 10), -0.7)
    got = model.scores(texts)
    for k in range(len(texts)):
        z = -0.7
        for f, c in zip(feature[doc == k], count[doc == k]):
            at = np.flatnonzero(some == f)
            if len(at):
                density = min(1.0, 2.0 * min(int(c), toxicity.MOST_COUNTED) / math.sqrt(max(words[k], 1)))
                z += model.weights[at[0]] + model.weights[5 + at[0]] * density
        assert abs(got[k] - 1 / (1 + math.exp(-z))) < 1e-12


def test_a_rare_class_keeps_its_prior(spark, monkeypatch):
    """One toxic row in a thousand: the risk is corrected for that share, not for a larger one."""
    rows = [(k, f"text number {k} " + ("vile stuff" if k % 1000 == 0 else "fine stuff"), "en", "s") for k in range(6000)]
    seen = []
    monkeypatch.setattr(toxicity, "fit_nnpu", lambda pos, unl, prior: seen.append(prior) or (np.zeros(pos.shape[1]), 0.0))
    toxicity.train(table(spark, rows), labels(spark, [(k, 1, int(k % 1000 == 0)) for k in range(6000)]))
    assert all(0.0003 < p < 0.003 for p in seen)


def test_toxicity_awkward(spark):
    docs = awkward(spark)
    bare = toxicity.score(docs, toxicity.train(docs, labels(spark))).collect()
    assert len(bare) == len(awkward_rows()) and len({r.score for r in bare}) == 1
    marks = labels(spark, [(100 + k, 1, int(k % 3 == 0)) for k in range(30)] + [(100, 1, None), (None, 1, 1), (101, 1, 0), (101, 1, 1)])
    model = toxicity.train(docs, marks)
    assert Counter(r.doc_id for r in toxicity.score(docs, model).collect()) == Counter(r[0] for r in awkward_rows())
    kept = toxicity.reject(docs, model)
    assert kept.columns == docs.columns and toxicity.reject(docs, model, 1.1).count() == docs.count()
    assert toxicity.score(empty(spark), toxicity.train(empty(spark), marks)).count() == 0


@pytest.mark.parametrize("none", [False, True])
def test_pipeline(spark, scratch, none):
    docs = empty(spark) if none else awkward(spark)
    folder = as_sf_dir(spark, docs, labels(spark, [] if none else [(100 + k, 1, int(k % 3 == 0)) for k in range(30)]), f"{scratch}/sf")
    rows = docs = read_table(spark, folder, "documents")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, rows, folder)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns
            out.write.parquet(f"{scratch}/{name}")
            out = spark.read.parquet(f"{scratch}/{name}")
        rows = out
    ours, whole = (sorted((str(r.doc_id), r.n_tokens, r.ids_sha256) for r in df.collect()) for df in (rows, corpus_pipeline.run(spark, folder)))
    assert ours == whole and bool(ours) != none
