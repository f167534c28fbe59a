"""Registered queries without SQL, against plain Python on the smallest tables."""

import hashlib
import os
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are absent")


@pytest.fixture(scope="module")
def texts(llm):
    return {r.doc_id: r.text or "" for r in llm.read.parquet(f"{FOLDER}/documents.parquet").collect()}


def run(spark, name):
    return entry.queries()[name](spark, FOLDER).collect()


def test_suffix_dedup(llm, texts):
    length, seen = 400, Counter()
    raw = {i: t.encode() for i, t in texts.items()}
    for t in raw.values():
        seen.update(t[k : k + length] for k in range(len(t) - length + 1))
    for row in run(llm, "op1_suffix_dedup"):
        t = raw[row.doc_id]
        gone = np.zeros(len(t), bool)
        for k in range(len(t) - length + 1):
            if seen[t[k : k + length]] > 1:
                gone[k : k + length] = True
        kept = bytes(np.frombuffer(t, np.uint8)[~gone])
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        assert (row.n_bytes, row.n_removed, row.n_spans) == (len(t), int(gone.sum()), spans)
        assert row.kept_sha256 == hashlib.sha256(kept).hexdigest()


KEYS = r"(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"


def secrets_of(text):
    found = [(m.start(), 0, "assign", m.end()) for m in re.finditer(KEYS + r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text) if len(m[1]) >= 12]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(found)


def test_secret_scan(llm, texts):
    for row in run(llm, "op7_secret_scan"):
        base = secrets_of(texts[row.doc_id])
        names = [f"{k}:{a}:{b}" for a, _, k, b in base]
        assert row.base_sha256 == hashlib.sha256(",".join(names).encode()).hexdigest()
        assert set(names) <= set(row.spans.split(","))
        assert (row.n_assign, row.n_access, row.n_hex) == tuple(sum(k == n for _, _, k, _ in base) for n in ("assign", "access", "hex"))


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text))
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(llm, texts):
    prints = {i: fingerprint(t) for i, t in texts.items()}
    root = {i: i for i in prints}
    changed = True
    while changed:
        changed = False
        for a in prints:
            for b in prints:
                if root[b] < root[a] and (prints[a] ^ prints[b]).bit_count() <= 3:
                    root[a], changed = root[b], True
    for row in run(llm, "op8_simhash"):
        assert row.fingerprint == f"{prints[row.doc_id]:016x}"
        assert row.component_id == root[row.doc_id]


def test_quality_rules(llm, texts):
    for row in run(llm, "op9_quality_rules"):
        text = texts[row.doc_id]
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        windows = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
        often, inside = Counter(windows), set()
        for k, w in enumerate(windows):
            if often[w] > 1:
                inside.update(range(k, k + 8))
        lines = Counter(x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x))
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words) == (
            len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), sum(c - 1 for c in lines.values()), len(inside)
        )
        assert row.base_failed == (len(words) < 20 or 100 * len(inside) > 30 * len(words))
        assert not (row.base_failed and row.kept)


def test_toxicity_is_learnt(llm):
    folder = FOLDER.replace("0.001", "0.01")
    labels = {r.doc_id: r.toxic for r in llm.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = entry.queries()["op6_toxicity"](llm, folder).collect()
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    toxic, clean = [r.score for r in held if labels[r.doc_id]], [r.score for r in held if not labels[r.doc_id]]
    wins = np.mean([[a > b for b in clean] for a in toxic])
    assert wins > 0.75 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def test_html_text(llm):
    rows = run(llm, "op10_html_text")
    assert all(r.n_chars == len(r.text) and "©" not in r.text and "\n\n" not in r.text for r in rows)


def test_mixing_reads_every_budget(llm):
    docs = {r.doc_id: r for r in llm.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = run(llm, "op2_temperature_mixing")
    tokens = {i: len(re.findall(r"[^\x20\x09-\x0D]+", d.text or "")) for i, d in docs.items()}
    total, read, weight, longest = sum(tokens.values()), Counter(), {}, Counter()
    for r in rows:
        read[r.source] += tokens[r.doc_id]
        weight[r.source] = r.mix_weight
        longest[r.source] = max(longest[r.source], tokens[r.doc_id])
    assert abs(sum(weight.values()) - 1) < 1e-9
    for source, n in read.items():
        assert weight[source] * total - 1 <= n <= weight[source] * total + longest[source] + 1
    shares = np.array(list(weight.values()))
    assert -(shares * np.log(shares)).sum() >= 0.97 * np.log(len(shares)) - 1e-6
