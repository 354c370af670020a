"""The five stages beside plain versions: one after the other on the whole smallest table, and each on awkward rows."""

from __future__ import annotations

import math
import re
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from millrace.llm import bpe, quality, secrets

FOLDER = "/root/testdata/sf0.001"
SPACE = r"[^\x20\x09-\x0D]"
PASSAGE = " ".join(f"p{k}" for k in range(90))
AWKWARD = [(0, None), (1, ""), (2, " \n\t "), (3, PASSAGE), (3, PASSAGE), (None, PASSAGE), (4, PASSAGE + " more"), (5, "word " * 60), (6, "x " + PASSAGE[::-1]),
           (7, 'key password = "hunter22" then token: abcdefghij ' + " ".join(f"q{k}" for k in range(70))), (None, None), (8, "w" * 200_000), (9, "é " * 70),
           (10, " ".join(f"long{k}" for k in range(40_000)))]


def words(text):
    return re.findall(SPACE + "+", text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def measures(text):
    text = text or ""
    w = words(text)
    windows = Counter(zip(w, w[1:], w[2:], strict=False))
    covered = {j for k in range(len(w) - 2) if windows[tuple(w[k : k + 3])] > 1 for j in (k, k + 1, k + 2)}
    lines = [line for line in text.split("\n") if words(line)]
    symbol = r"[#*$%&|<>]"
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": len(re.findall(symbol, text)), "n_dup_lines": len(lines) - len(set(lines)),
            "n_repeat_words": len(covered), "n_lines": len(lines), "n_symbol_runs": len(re.findall(symbol + "{3,}", text)),
            "n_bare_symbols": len(re.findall(rf"(?<!{SPACE}){symbol}+(?!{SPACE})", text)), "n_capitals": len(re.findall("[A-Z]", text)),
            "n_exclamations": text.count("!")}


def plain_fit(votes, rules, rounds=12, tolerance=1e-4):
    """Expectation-maximisation over single documents; the smoothing and the bound on complaints as documented."""
    good, by = 0.9, [quality.START] * rules

    def posterior(vote):
        logit = math.log(good / (1 - good)) + sum(math.log(by[k][True][v] / by[k][False][v]) for k, v in enumerate(vote))
        return 1 / (1 + math.exp(-logit))

    for _ in range(rounds if votes else 0):
        weights = [posterior(v) for v in votes]
        total, last = sum(weights), good
        new = []
        for k in range(rules):
            share = {c: {v: ((sum(w if c else 1 - w for w, vote in zip(weights, votes, strict=True) if vote[k] == v)) + 0.5)
                         / ((total if c else len(votes) - total) + 1.5) for v in quality.VOTES} for c in (True, False)}
            most = share[False][-1] / quality.COMPLAINT_RATIO
            if share[True][-1] > most:
                rest = (1 - most) / (1 - share[True][-1])
                share[True] = {v: most if v == -1 else x * rest for v, x in share[True].items()}
            new.append(share)
        good, by = (total + 0.5) / (len(votes) + 1), new
        if abs(last - good) < tolerance:
            break
    return [posterior(v) for v in votes]


def rules_kept(rows):
    found = [measures(r[1]) for r in rows]
    con = duckdb.connect()
    names = list(quality.MEASURES)
    con.execute(f"CREATE TABLE m (k INT, {', '.join(f'{n} BIGINT' for n in names)})")
    con.executemany(f"INSERT INTO m VALUES ({', '.join('?' * (len(names) + 1))})", [(k, *(m[n] for n in names)) for k, m in enumerate(found)]) if rows else None
    columns = [f"CASE WHEN {r.bad} THEN -1 WHEN {r.good} THEN 1 ELSE 0 END".format(**{n: n for n in names}) for r in quality.RULES]
    votes = con.execute(f"SELECT {', '.join(columns)} FROM m ORDER BY k").fetchall()
    good = plain_fit(votes, len(quality.RULES))
    failed = [m["n_words"] < 50 or 100 * m["n_repeat_words"] > 50 * m["n_words"] for m in found]
    return [r for r, f, g in zip(rows, failed, good, strict=True) if not f and g >= 0.5]


def one_of_each(rows):
    sets = []
    for _, text, *_ in rows:
        w = words(lower(text))
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))})
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if min(len(sets[a]), len(sets[b])) >= 0.8 * max(len(sets[a]), len(sets[b])) and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    best = {}
    for k, row in enumerate(rows):
        place = (row[0] is None, row[0] or 0)
        if find(k) not in best or place < best[find(k)][0]:
            best[find(k)] = (place, row)
    return [row for _, row in best.values()]


def clean_ones(rows, bench):
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = set()
    for text in bench:
        w = pattern.findall(lower(text))
        windows |= {tuple(w[k : k + 10]) for k in range(max(1, len(w) - 9))} if w else set()
    out = []
    for row in rows:
        w = pattern.findall(lower(row[1]))
        if not any(tuple(w[k : k + n]) in windows for n in {len(x) for x in windows} for k in range(len(w) - n + 1)):
            out.append(row)
    return out


def redacted(text):
    spans = []
    for kind, rule in enumerate(secrets.RULES):
        spans += [(m.start(), kind, m.end()) for m in re.finditer(rule.pattern, text or "") if len(m[rule.group]) >= rule.least]
    out, end = [], 0
    for start, _, stop in sorted(spans):
        if start >= end:
            out += [text[end:start], "[SECRET]"]
        end = max(end, stop)
    return "".join([*out, text[end:]]) if spans else text


@pytest.fixture(scope="module")
def library():
    ranks = bpe.read_ranks(bpe.public_vocabulary()[0])
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def rows_of(frame):
    return [tuple(r) for r in frame.collect()]


@pytest.fixture
def awkward(stored):
    return stored([t for _, t in AWKWARD], [i for i, _ in AWKWARD], ["_row", "n_words", "found", "blob", "votes", "ids"])


def same(left, right):
    assert Counter(left) == Counter(right)


def test_all_stages_on_a_whole_table(spark, library):
    rows = rows_of(spark.read.parquet(f"{FOLDER}/documents.parquet"))
    bench = [r.text for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    left = clean_ones(one_of_each(rules_kept(rows)), bench)
    want = []
    for doc_id, text, *_ in left:
        ids = library(redacted(text) or "")
        want.append((doc_id, len(ids), np.array(ids, "<u4").tobytes(), True))
    same([(*r[:2], bytes(r[2]), r[3]) for r in rows_of(corpus_pipeline.run(spark, FOLDER))], want)


def test_quality_stage(spark, awkward, stored):
    for docs in (awkward, stored([])):
        kept = corpus_pipeline.quality_rules(spark, docs, FOLDER)
        assert kept.columns == docs.columns
        same(rows_of(kept), rules_kept(rows_of(docs)))


def test_near_duplicate_stage(spark, awkward, stored):
    for docs in (awkward, stored([])):
        kept = corpus_pipeline.near_duplicates(spark, docs, FOLDER)
        assert kept.columns == docs.columns
        same([r[:2] for r in rows_of(kept)], [r[:2] for r in one_of_each(rows_of(docs))])


def test_decontamination_stage(spark, awkward, stored):
    bench = [r.text for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    for docs in (awkward, stored([]), stored([bench[0], None, "clean words only", f"before {bench[1]} after"])):
        kept = corpus_pipeline.benchmark_decontamination(spark, docs, FOLDER)
        assert kept.columns == docs.columns
        same(rows_of(kept), clean_ones(rows_of(docs), bench))


def test_secret_stage(spark, awkward, stored):
    for docs in (awkward, stored([])):
        clean = corpus_pipeline.secret_scans(spark, docs, FOLDER)
        assert clean.columns == docs.columns
        same([r[:2] for r in rows_of(clean)], [(r[0], redacted(r[1])) for r in rows_of(docs)])
        assert clean.filter("n_chars != length(text)").isEmpty()


def test_encoding_stage(spark, awkward, stored, library):
    for docs in (awkward, stored([])):
        found = corpus_pipeline.byte_level_bpe(spark, docs, FOLDER)
        want = [(r[0], np.array(library(r[1] or ""), "<u4").tobytes()) for r in rows_of(docs)]
        same([(r[0], bytes(r[2])) for r in rows_of(found)], want)
        assert all(r[3] and r[1] == len(r[2]) // 4 for r in rows_of(found))
