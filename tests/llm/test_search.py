"""Personal data, decontamination, revisits and toxicity against plain Python, and the pipeline's stages."""

import hashlib
import random
import re
import time
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import cases
from threadline.llm import decontaminate, line_quality, pii, revisits, simhash, toxicity

SF = "/root/testdata/sf0.001"


def luhn(digits):
    doubled = [int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits))]
    return sum(doubled) % 10 == 0


def plain_spans(text):
    rules = (
        (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
        (r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= sum(c.isdigit() for c in m) <= 19 and luhn(re.sub("[ -]", "", m))),
        (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= sum(c.isdigit() for c in m) <= 15),
    )
    return sorted((m.start(), k, m.end()) for k, (rule, holds) in enumerate(rules) for m in re.finditer(rule, text) if holds(m.group()))


def test_base_patterns():
    rng = random.Random(6)
    parts = ["a@b.com", "x_y@q-r.co.uk", "@", "1.2.3.4", "256.1.1.1", "001.02.3.255", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (555) 010-9999", "+12", ".", "-", " ", "é", "7", "12", "a%", "_x@c.de", "..", "+", "("]
    for _ in range(5000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(1, 9)))
        assert pii.base_spans(text) == plain_spans(text), text


def test_crf_finishes_long_runs_one_by_one():
    crf = pii.Crf({}, np.zeros((0, 3)), np.random.default_rng(3).normal(size=(3, 3)))
    rng = np.random.default_rng(8)
    lengths = np.concatenate([rng.integers(1, 30, 300), [200_000, 40, 41]])
    rng.shuffle(lengths)
    scores = np.round(rng.normal(size=(lengths.sum(), 3)) * 2)  # with ties
    began = time.process_time()
    got = crf.decode(scores, lengths)
    assert time.process_time() - began < 2  # a step of all runs for each of its tokens takes four seconds
    at = 0
    for n in lengths.tolist():  # plain Viterbi
        best, back = scores[at] + crf.step[0], []
        best[2] = -np.inf
        for t in range(1, min(n, 500)):
            paths = best[:, None] + crf.step
            paths[0, 2] = -np.inf
            back.append(paths.argmax(axis=0))
            best = paths.max(axis=0) + scores[at + t]
        if n <= 500:
            label, want = int((best + crf.step[:, 0]).argmax()), []
            for step in [*reversed(back), None]:
                want.append(label)
                label = int(step[label]) if step is not None else 0
            assert got[at : at + n].tolist() == want[::-1]
        else:
            whole = pii.Crf.decode(crf, scores[at : at + n], np.array([n]))
            assert (got[at : at + n] == whole).all() and not ((whole[:-1] == 0) & (whole[1:] == 2)).any()
        at += n


def test_looks_of_words_and_signs():
    rng = random.Random(5)
    for _ in range(5000):
        word = "".join(rng.choice("aA1é²ªßǅZzÉf90") for _ in range(rng.randint(1, 9))) if rng.random() < 0.9 else rng.choice("_-,.#é")
        _, _, _, mixed, turns, unlettered, shape, _, _ = pii._looks(word)
        letters = sum(c.isalpha() for c in word)
        assert (mixed, unlettered, shape) == (0 < letters < len(word), letters == 0, pii._shape(word)[:6])
        assert turns == min(sum(a.isdigit() != b.isdigit() for a, b in zip(word, word[1:], strict=False)), 8) // 2


def test_crf_decodes_the_best_labels():
    crf = pii.train()
    rng = np.random.default_rng(8)
    lengths = rng.integers(1, 6, 60)
    scores = rng.normal(size=(lengths.sum(), 3)) * 2
    got = crf.decode(scores, lengths)
    at = 0
    for n in lengths:
        def value(path, at=at, n=n):
            steps = [0, *path, 0]
            if any(a == 0 and b == 2 for a, b in zip(steps, steps[1:], strict=False)):
                return -np.inf
            return sum(scores[at + i, p] for i, p in enumerate(path)) + sum(crf.step[a, b] for a, b in zip(steps, steps[1:], strict=False))

        best = max(np.ndindex(*[3] * n), key=value)
        assert np.isclose(value(tuple(got[at : at + n])), value(best))
        at += n


def test_crf_on_new_sentences():
    crf = pii.train()
    rng = random.Random(99)
    right = 0
    for i in range(200):
        value = "".join(rng.choice("0123456789abcdef") for _ in range(40))
        text = rng.choice(("and token = \"{}\" more", "PASSWORD: {} end", "api key = '{}'")).format(value)
        (_, every), = pii._all_spans(crf, [text])
        right += [text[a:b] for a, k, b in every if k == 4] == [value]
    assert right >= 195
    for clean in ("Paid 500648960 on 20240101 for Model1234X", "see page 12345678 of 9", "no digits at all here", "call 047369625730995 now"):
        assert not [s for s in next(pii._all_spans(crf, [clean]))[1] if s[1] == 4]


def test_pii_query(spark):
    rows = cases.odd_rows()
    extra = (30, "mail me at a.b@c.de or +1 (555) 010-9999; token = \"" + "0a" * 20 + "\"", "en", "s", 1, "x", "y")
    got = pii.find_pii(cases.frame(spark, [*rows, extra])).collect()
    assert len(got) == len(rows) + 1
    for r in got:
        if r["doc_id"] == 30:
            names = ("email", "ip", "card", "phone")
            base = ",".join(f"{names[k]}:{a}:{b}" for a, k, b in plain_spans(extra[1]))
            assert r["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
            assert r["spans"].startswith(base) and "secret:" in r["spans"] and (r["n_email"], r["n_phone"]) == (1, 1)
    docs = cases.frame(spark, [*rows, extra])
    clean = {r["doc_id"]: r for r in pii.redact(docs).collect()}
    assert clean[30]["text"] == 'mail me at [EMAIL] or [PHONE]; token = "[SECRET]"' and clean[30]["n_chars"] == len(clean[30]["text"])
    assert clean[5]["text"] is None and clean[1]["text"] == rows[0][1]
    assert pii.find_pii(cases.frame(spark, [])).count() == 0


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def test_lcs():
    rng = random.Random(3)
    for _ in range(300):
        a, b = (["".join(rng.choice("abc")) for _ in range(rng.randrange(0, 15))] for _ in range(2))
        assert decontaminate.lcs(a, b) == plain_lcs(a, b)


def normal(text):
    return " " + " ".join(decontaminate.words_of(text or "")) + " "


def test_every_whole_passage_is_found_and_nothing_else(spark):
    docs, items = cases.documents(spark), spark.read.parquet(f"{SF}/benchmark.parquet")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(docs, items).collect()}
    want = {(d["doc_id"], i["item_id"]) for d in docs.collect() for i in items.collect() if normal(i["text"]) in normal(d["text"])}
    assert want <= got
    for d, i in got - want:  # anything more shares most of the passage
        text = docs.where(F.col("doc_id") == d).first()["text"]
        item = items.where(F.col("item_id") == i).first()["text"]
        assert plain_lcs(decontaminate.words_of(item), decontaminate.words_of(text)) >= 0.6 * len(decontaminate.words_of(item))


def test_paraphrases_are_found(spark):
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    rng = random.Random(4)
    rows = []
    for r in items.collect():
        words = r["text"].split()
        kept = [w for w in words if rng.random() > 0.12]
        for at in range(6, len(kept), 9):
            kept[at:at] = ["inserted"]
        rows.append((r["item_id"], "some words before it " * 20 + " ".join(kept) + " and some after it" * 20))
    docs = cases.frame(spark, [(i, t, "en", "s", 1, "", "") for i, t in rows] + cases.odd_rows()[:18])
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(docs, items).collect()}
    assert sum((i, i) in got for i, _ in rows) >= 0.9 * len(rows)
    assert decontaminate.find_leaks(docs.limit(0), items).count() == 0
    assert decontaminate.find_leaks(docs, items.limit(0)).count() == 0


def captured(spark, rows):
    return spark.createDataFrame(rows, "record_id long, url string, ts long, status int, headers map<string,string>, part string, end string")


def test_revisits(spark):
    rng = random.Random(5)
    rows = []
    for i in range(600):
        url = "http://hot.example.com/" if i % 3 == 0 else rng.choice((None, "http://A.example.com:80/x#top", "http://a.example.com/x?utm_source=y", "https://b.example.com", "no url"))
        headers = rng.choice((None, {}, {"etag": "1"}, {"etag": 'W/1'}, {"etag": "2", "content-length": str(i)}, {"last-modified": "m", "date": str(i)}))
        rows.append((i, url, rng.choice((None, *range(40))), rng.choice((200, 304, 304, 404)), headers, "p", "e"))
    got = {r["record_id"]: r for r in revisits.resolve_revisits(captured(spark, rows).repartition(7)).collect()}
    keys = {None: None, "http://hot.example.com/": "http://hot.example.com/", "http://A.example.com:80/x#top": "http://a.example.com/x", "http://a.example.com/x?utm_source=y": "http://a.example.com/x", "https://b.example.com": "https://b.example.com/", "no url": "no url"}
    assert set(got) == {r[0] for r in rows if r[3] == 304}
    for i, url, ts, status, headers, *_ in rows:
        if status != 304:
            continue
        mine = headers or {}
        earlier = [r for r in rows if r[3] == 200 and url is not None and keys[r[1]] == keys[url] and None not in (ts, r[2]) and r[2] < ts]
        base = max(earlier, key=lambda r: (r[2], r[0]), default=None)
        theirs = (base[4] or {}) if base else {}
        strip = lambda h: h["etag"].removeprefix("W/") if "etag" in h else None
        if base is None:
            verdict = "missing"
        elif strip(mine) is not None and strip(theirs) is not None:
            verdict = "resolved" if strip(mine) == strip(theirs) else "changed"
        elif "last-modified" in mine and "last-modified" in theirs:
            verdict = "resolved" if mine["last-modified"] == theirs["last-modified"] else "changed"
        else:
            verdict = "unvalidated"
        r = got[i]
        assert (r["url_key"], r["verdict"]) == (keys[url], verdict), (i, url, ts)
        if verdict == "resolved":
            assert r["resolved_id"] == base[0]
            assert r["merged"] == theirs | {k: v for k, v in mine.items() if k not in revisits.KEPT_FIELDS}
        else:
            assert r["resolved_id"] is None and r["merged"] is None
    assert revisits.resolve_revisits(captured(spark, [])).count() == 0


def test_neighbours_are_exact():
    rng = np.random.default_rng(9)
    vectors = np.where(rng.random((700, 40)) < 0.1, rng.random((700, 40)), 0)
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    vectors = np.divide(vectors, norms, out=np.zeros_like(vectors), where=norms > 0)
    vectors[300:340] = vectors[0]  # ties
    ids = rng.permutation(700)
    index = toxicity.Neighbours(ids, rng.integers(0, 2, 700).astype(float), vectors, 0.1)
    for query in vectors[:80]:
        if not query.any():
            continue
        rows, cosines = index.nearest(query, 15)
        every = np.round(vectors @ query, 12)
        best = [k for k in np.lexsort((ids, -every))[:15] if every[k] > 0]
        assert index.ids[rows].tolist() == ids[best].tolist()
        assert np.allclose(cosines, every[best])


def test_toxicity_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = {r["doc_id"]: r for r in toxicity.score_toxicity(docs, labels).collect()}
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in got.items())
    known = [(r["toxic"], got[r["doc_id"]]) for r in labels.collect() if r["doc_id"] in got and r["toxic"] is not None]
    held = [(t, r["score"]) for t, r in known if r["held_out"]]
    toxic, clean = [s for t, s in held if t], [s for t, s in held if not t]
    assert np.mean([[a > b for b in clean] for a in toxic]) > 0.8
    assert np.mean([s >= 0.7 for s in clean]) < 0.02
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in got.values())


def test_toxicity_learns_from_the_rest_only(spark):
    docs = cases.frame(spark)
    labels = spark.createDataFrame([(i, 1, int(i % 2)) for i in range(20)] + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    held = [i for i in range(20) if zlib.crc32(str(i).encode()) % 3 == 1]
    turned = labels.withColumn("toxic", F.when(F.col("doc_id").isin(held), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, other = (Counter((r["doc_id"], r["score"]) for r in toxicity.score_toxicity(docs, t).collect()) for t in (labels, turned))
    assert one == other and sum(one.values()) == len(cases.odd_rows())
    assert toxicity.score_toxicity(docs.limit(0), labels).count() == 0
    assert {r["score"] for r in toxicity.score_toxicity(docs, labels.limit(0)).collect()} == {0.0}


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "simhash_near_dedup", "benchmark_decontamination", "pii", "packing"]
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, SF)
        rows = {r["doc_id"]: r for r in after.collect()}
        old = {r["doc_id"]: r for r in before.collect()}
        assert after.columns == columns and set(rows) <= set(old)
        if name == "quality_rules":
            want = {r["doc_id"] for r in line_quality.report(before).collect() if r["kept"]}
        elif name == "simhash_near_dedup":
            want = {r["component_id"] for r in simhash.simhash_components(before).collect()}
        elif name == "benchmark_decontamination":
            want = set(old) - {r["doc_id"] for r in decontaminate.find_leaks(before, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
        else:
            want = set(old)
            assert not any(plain_spans(r["text"]) for r in rows.values())
        assert set(rows) == want
        before = spark.createDataFrame(list(rows.values()), docs.schema)
    packed = corpus_pipeline.STAGES[-1][1](spark, before, SF)
    assert Counter(r["doc_id"] for r in corpus_pipeline.run(spark, SF).collect()) == Counter(r["doc_id"] for r in packed.collect())


@pytest.mark.parametrize("name", ["op2_line_quality", "op8_revisit_resolution"])
def test_sql_twins(spark, name):
    from tests.compare import connect, difference
    from threadline.llm.queries import ORACLES, QUERIES

    assert duckdb.__version__
    assert difference(spark, SF, QUERIES[name], ORACLES[name], connect(SF))[0] is None


def test_crf_finds_secrets_of_several_tokens():
    crf = pii.train()
    rng = random.Random(7)

    def of(letters, n):
        return "".join(rng.choice(letters) for _ in range(n))

    people = [f"{a} {b}" for a in ("Rosalind", "Tobias", "Priscilla", "Maria", "Edward") for b in ("Thornbury", "Gonzalez", "Whitaker", "Kowalczyk")]
    places = [f"{n} {s}" for n in (12, 408, 7) for s in ("Elm Street", "Juniper Hollow Road", "Cedar Avenue", "Windmill Lane")]
    passwords = ["correcthorsebattery", "purplemonkeydishwasher", "swordfishlantern", "quietriverstone", "BlueHarvestMoon"]
    digits, letters = "0123456789", "abcdefghijkmnpqrstuvwxyzABCDEFGHJKLMNPQRSTUVWXYZ23456789"
    kinds = {
        "name": [f"please ask. Contact: {p}, who knows" for p in people],
        "address": [f"the parcel will ship to {p}. Thanks" for p in places],
        "password": [f"then login with {c}{p} and go" for p in passwords for c in ("password = ", "passphrase: ", "Password: ")],
        "grouped": [f"enter license key: {'-'.join(of(letters, 4) for _ in range(4))} to start" for _ in range(40)],
        "uuid": [f"with api key = \"{'-'.join(of(digits + 'abcdef', n) for n in (8, 4, 4, 4, 12))}\" set" for _ in range(40)],
    }
    values = {"name": people, "address": places, "password": [p for p in passwords for _ in range(3)]}
    recall = {}
    for kind, texts in kinds.items():
        wanted = values.get(kind) or [max(re.findall(r"[\w-]+", t), key=len) for t in texts]
        got = [[t[a:b] for a, k, b in spans if k == 4] for t, (_, spans) in zip(texts, pii._all_spans(crf, texts), strict=True)]
        recall[kind] = sum([w] == g for w, g in zip(wanted, got, strict=True)) / len(texts)
    print(recall)
    assert min(recall.values()) >= 0.8, recall
    (_, spans), = pii._all_spans(crf, ["Maria Gonzalez, 12 Elm Street"])
    assert [(a, b) for a, _, b in spans] == [(0, 14), (16, 29)]


def test_cutting_the_chain_changes_no_label(monkeypatch):
    scorer = pii._Scorer(pii.train())
    texts = ["".join(t) for t, _ in pii.labelled_table()[:150]] + ["", " ", "é"]
    cut = pii.secrets(scorer, texts)
    monkeypatch.setattr(pii, "_may_be_inside", lambda step, scores: np.ones(len(scores) - 1, bool))
    assert pii.secrets(scorer, texts) == cut and any(cut)
    monkeypatch.setattr(pii, "_SCORED", 7)
    assert pii.secrets(scorer, texts) == cut
    table = [t for t, _ in pii.labelled_table()[:20]]
    for tokens in table:  # the shares of tokens add up to the features' weights
        ids = np.array([0, 0, 0, *map(scorer.id_of, tokens), 0, 0, 0], np.int32)
        plain = scorer.crf.emissions([pii._features(tokens[max(0, i - 3) : i], t, tokens[i + 1 : i + 3]) for i, t in enumerate(tokens)])
        assert np.allclose(scorer.emissions(ids, 3, 3 + len(tokens)), plain)
