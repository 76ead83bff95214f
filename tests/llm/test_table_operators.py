"""Sharding, mixing, token blocks, the pipeline and the registered queries."""

import math
import random
import zlib

import numpy as np
import pytest
from fixtures import corpus, edges, frame, rows_of
from hypothesis import given, settings
from hypothesis import strategies as st

from sevlab.llm import jump_shards, temperature_mix, token_blocks


def jump(key, n):
    """The published algorithm, step by step."""
    key, b, j = key % 2**64, -1, 0
    while j < n:
        b, key = j, (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(-2**63, 2**63 - 1), min_size=1, max_size=30), st.integers(1, 40))
def test_jump(keys, n):
    got, grown = (jump_shards.jump(np.array(keys), k).tolist() for k in (n, n + 1))
    assert got == [jump(k, n) for k in keys]
    assert all(a == b or b == n for a, b in zip(got, grown, strict=True))


def test_shards(spark, monkeypatch):
    monkeypatch.setattr(jump_shards, "BLOCK", 7)
    rows = corpus(150) + edges()
    got = jump_shards.assign(frame(spark, rows, clash=True)).collect()
    text = lambda r: (r[1] or "").encode()
    expected = sorted(((r[0], len(text(r)) + 1, zlib.crc32(text(r)), jump(r[0] or 0, 16), jump(r[0] or 0, 17)) for r in rows), key=repr)
    assert sorted(((r.doc_id, r.size, r.text_crc32, r.shard, r.grown_shard) for r in got), key=repr) == expected
    for s in range(16):
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots == list(range(len(slots)))
        ordered = [(r.doc_id is not None, r.doc_id or 0) for r in sorted(got, key=lambda r: r.slot) if r.shard == s]
        assert ordered == sorted(ordered)
    docs = frame(spark, rows, clash=True)
    assert jump_shards.add_shard(docs).columns == [*docs.columns, "_shard"]
    assert jump_shards.assign(docs.limit(0)).count() == 0
    names = docs.selectExpr("concat('k', doc_id) AS name")
    assert {r.shard for r in jump_shards.add_shard(names, "name", 4).collect()} <= set(range(4))


def mixture(rows):
    """alpha by bisection, quotas, and each source's epochs as sorted lists."""
    import hashlib

    words = [len([w for w in (r[1] or "").replace("\x0b", " ").replace("\x0c", " ").replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if w]) for r in rows]
    tokens = {}
    for r, n in zip(rows, words, strict=True):
        tokens[r[3]] = tokens.get(r[3], 0) + n
    total = sum(tokens.values())
    share = {s: t / total for s, t in tokens.items() if t}
    entropy = lambda w: -sum(x * math.log(x) for x in w)

    def weights(a):
        z = sum(x**a for x in share.values())
        return {s: x**a / z for s, x in share.items()}

    target = entropy(share.values()) + temperature_mix.ENTROPY_GAIN * (math.log(len(share)) - entropy(share.values()))
    low, high = 0.0, 1.0
    for _ in range(30):
        a = (low + high) / 2
        repeats = (max(share.values()) / min(share.values())) ** (1 - a)
        low, high = (low, a) if entropy(weights(a).values()) <= target and repeats <= temperature_mix.MAX_REPEATS else (a, high)
    alpha = round(high, 6)
    w = weights(alpha)
    budget = math.ceil(round(max(share[s] / share[s] ** alpha for s in share) * sum(x**alpha for x in share.values()) * total, 3))
    hashed = lambda e, d: int(hashlib.md5(f"17:{e}:{'' if d is None else d}".encode()).hexdigest()[:15], 16)
    out = []
    for source, t in tokens.items():
        mine = [(r[0], n) for r, n in zip(rows, words, strict=True) if r[3] == source]
        if not t:
            out += [(d, source, n, 0) for d, n in mine]
            continue
        quota = math.floor(round(w[source] * budget, 3))
        for e in range(quota // t + 1):
            at = e * t
            groups = {}
            for d, n in mine:
                groups.setdefault(hashed(e, d), []).append((d, n))
            for h in sorted(groups):
                if e < quota // t or at < quota:
                    out += [(d, source, n, e) for d, n in groups[h]]
                at += sum(n for _, n in groups[h])
    return alpha, w, out


def test_mixture_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(temperature_mix, "BUCKET_ROWS", 16)
    monkeypatch.setattr(temperature_mix, "BLOCK_TOKENS", 3000)
    rows = corpus(200) + edges() + [(4000, None, "en", "empty", 0)]
    alpha, w, expected = mixture(rows)
    docs = frame(spark, rows, clash=True)
    got = temperature_mix.mixture(docs).collect()
    assert sorted((tuple(r)[:4] for r in got), key=repr) == sorted(expected, key=repr)
    assert 0 < alpha < 1
    ids = sorted(((e[0], e[1]) for e in expected), key=repr)
    out = temperature_mix.mixed_documents(docs)
    assert out.columns == docs.columns
    assert rows_of(out, "doc_id", "source") == ids
    assert {(r[0], r[3]) for r in rows} == set(ids)  # no document is lost under the default budget
    tokens = {}
    for r in got:
        tokens[r.block, r.source] = tokens.get((r.block, r.source), 0) + r.n_tokens
    blocks = max(r.block for r in got) + 1
    assert blocks > 3
    for source, share in w.items():
        if share > 0.2:  # every block holds about its share
            whole = sum(n for (_, s), n in tokens.items() if s == source)
            assert all(abs(tokens.get((b, source), 0) - whole / blocks) < 0.35 * whole / blocks + max(r.n_tokens for r in got) for b in range(blocks))


def test_mixture_budget_single_source_and_empty(spark):
    rows = [(i, "one two three", "en", "only", 0) for i in range(10)]
    assert temperature_mix.mixture(frame(spark, rows)).count() == 10
    assert temperature_mix.mixture(frame(spark, rows), budget=9).count() == 3
    assert temperature_mix.mixture(frame(spark, rows).limit(0)).count() == 0
    assert temperature_mix.mixed_documents(frame(spark, rows).limit(0)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=1600), st.randoms())
def test_blocks_round_trip(ids, rng):
    values = np.array(ids, "<u4")
    docs = [rng.choice((None, 5, -7))]
    back = token_blocks.unpack(token_blocks.pack(docs, np.array([len(values)]), values))
    assert back[0] == docs and back[1].tolist() == [len(values)] and back[2].tolist() == ids


def test_blocks_are_small_and_random_access():
    ids = np.random.default_rng(0).integers(0, 1000, 50_000).astype("<u4")
    ids[::97] += 40_000
    segment = token_blocks.pack([1], np.array([len(ids)]), ids)
    assert len(segment) < 1.5 * len(ids)
    for n in (1, 511, 512, 513, 5000):
        ids[:3] = 2**32 - 1, 0, 70_000
        part = token_blocks.pack([7, None], np.array([n - 1, 1]), ids[:n])
        _, _, whole = token_blocks.unpack(part)
        blocks = [token_blocks.read_block(part, k) for k in range(-(-n // token_blocks.BLOCK))]
        assert np.array_equal(np.concatenate(blocks), ids[:n]) and np.array_equal(whole, ids[:n])
        with pytest.raises(IndexError):
            token_blocks.read_block(part, len(blocks))
    same = token_blocks.pack([1], np.array([600]), np.full(600, 9, "<u4"))  # no bits at all
    assert (token_blocks.read_block(same, 1) == 9).all()


def tokenizer_file() -> str:
    """Only tests of the tokenizer are left out where there is none."""
    return pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")


def test_encoder_equals_the_whole_tokenizer():
    from tokenizers import Tokenizer

    whole, pieces = Tokenizer.from_file(tokenizer_file()), token_blocks.PieceEncoder(tokenizer_file())
    rng = random.Random(1)
    texts = [r[1] or "" for r in corpus(40) + edges()] + ["it's <|endoftext|> don't.' x_1 12.5!!", "É ÉA. Σ ΟΔΟΣ. İ ﬁ Ⅳ é a\x1cb a\x85b a b", "ÀÖØÞ×÷ß ÿ.%%% Ñandú###"]
    texts += ["".join(rng.choices("aBé.,'! 1\ńßÑ×<|>", k=30)) for _ in range(1500)]
    for t in texts:
        assert np.frombuffer(pieces.encode(t.encode()), "<u4").tolist() == whole.encode(t, add_special_tokens=False).ids, t


def test_token_files(spark, monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(token_blocks, "SEGMENT_IDS", 500)
    whole = Tokenizer.from_file(tokenizer_file())
    rows = corpus(80) + edges()
    segments = token_blocks.write_segments(frame(spark, rows, clash=True), tokenizer_file(), 2)
    assert segments.count() > 10
    got = token_blocks.read_documents(segments, with_ids=True).orderBy("start").collect()
    ids = {}
    for r in rows:
        ids.setdefault(r[0], []).append([*whole.encode(r[1] or "", add_special_tokens=False).ids, 2])
    at = 0
    for r in got:
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(r.ids), zlib.crc32(np.array(r.ids, "<u4").tobytes()))
        ids[r.doc_id].remove(r.ids)
        at += r.n_tokens
    assert not any(ids.values())
    order = [(r.doc_id is not None, r.doc_id or 0) for r in got]
    assert order == sorted(order)
    assert token_blocks.read_documents(token_blocks.write_segments(frame(spark, rows).limit(0), tokenizer_file(), 2)).count() == 0


def test_pipeline_equals_its_stages_on_the_small_tables(spark):
    """Each stage against the operators' verdicts; the operators' own tests hold those against brute force."""
    import corpus_pipeline
    from sevlab.llm import jaccard_join, latent_leaks, mcd_rules
    from sevlab.llm.common import documents

    sf = "/root/testdata/sf0.001"
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "decontamination", "source_mixing", "sharding"]
    docs = documents(spark, sf)
    kept = {r.doc_id for r in mcd_rules.judge(docs).filter("kept").collect()}
    good = docs.filter(docs.doc_id.isin(list(kept)))
    joined = jaccard_join.join(good, 5, 80)
    one = {r.doc_id for r in joined.filter("doc_id = component_id OR n_shingles = 0").collect()}
    leaks = {r.doc_id for r in latent_leaks.leaks(docs, spark.read.parquet(f"{sf}/benchmark.parquet")).collect()}
    out = corpus_pipeline.run(spark, sf)
    assert out.columns == [*docs.columns, "shard"]
    rows = out.collect()
    assert {r.doc_id for r in rows} == one - leaks
    assert all(r.shard == jump(r.doc_id, 16) for r in rows)


def test_registered_queries():
    import __spark_entry__ as entry

    names = set(entry.queries())
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names
    assert {n for n in entry.oracle_sql() if n.startswith("op")} >= {n for n in names if n.split("_")[0] in ("op4", "op5", "op8", "op9", "op10")}
