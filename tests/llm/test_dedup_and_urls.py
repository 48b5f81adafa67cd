import hashlib
import random
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tagloom.llm import exact_dedup, minhash, url_filter
from tagloom.llm.common import fresh_dir
from tagloom.llm.components import components


@pytest.fixture(params=["documents", "odd_docs", "no_docs"])
def docs(request):
    return request.getfixturevalue(request.param)


def key(row):
    return tuple((v is not None, str(v)) for v in row)


def plain_groups(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    out = []
    for doc_id, text in rows:
        own = groups[text or ""]
        keep = max((d for d in own if d is not None), default=None)
        out.append((doc_id, keep, len(own), doc_id == keep, hashlib.sha256((text or "").encode()).hexdigest()))
    return out


@pytest.mark.parametrize("hash_bits,capacity", [(63, 1024), (6, 2)])
def test_exact_duplicates(docs, hash_bits, capacity):
    """Also with so few bits that keys collide and buckets split to the end."""
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = [tuple(r) for r in exact_dedup.mark_duplicates(docs, hash_bits=hash_bits, capacity=capacity).collect()]
    assert sorted(got, key=key) == sorted(plain_groups(rows), key=key)


def test_index_answers_from_its_files(documents, spark):
    index = exact_dedup.build_index(documents, fresh_dir(spark, "index"), capacity=3)
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    want = {text: (keep, size) for (_, text), (_, keep, size, _, _) in zip(rows, plain_groups(rows))}
    found = exact_dedup.look_up(index, documents.select("text").distinct().unionByName(spark.createDataFrame([("not there",)], "text string"))).collect()
    assert {r.text: (r.keep_id, r.group_size) for r in found} == want | {"not there": (None, None)}


def test_look_up_after_the_session_changed(documents, spark):
    """The owner bits come from the stored directory, not from the session's shuffle setting."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    index = exact_dedup.build_index(documents, fresh_dir(spark, "index"), capacity=3)
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    want = {text: (keep, size) for (_, text), (_, keep, size, _, _) in zip(rows, plain_groups(rows))}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", str(8 * int(before)))
        found = exact_dedup.look_up(index, documents.select("text").distinct()).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert {r.text: (r.keep_id, r.group_size) for r in found} == want


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 63), st.sampled_from("abc")), max_size=60), st.integers(1, 4))
def test_directory(entries, capacity):
    directory, done = exact_dedup.Directory(6, capacity), []
    current = None
    for k, text in sorted(entries):
        bucket = directory.insert(k, text, 1, 1)
        if current is not None and bucket is not current:
            done += directory.take_before(bucket)
        current = bucket
    buckets = done + directory.remaining()
    got = Counter({(k, e[0]): e[2] for b in buckets for k, chain in b.chains.items() for e in chain})
    assert got == Counter(entries)
    for b in buckets:
        assert all(k >> (6 - b.depth) == b.prefix for k in b.chains)
        assert b.texts <= capacity or len(b.chains) == 1 or b.depth == 6


def plain_components(rows):
    sets = {}
    for doc_id, text in rows:
        words = (text or "").encode().lower().split()
        sets[doc_id] = frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)] if words else [])
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d), find(d) == d) for d in ids}


def test_near_duplicates(docs):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    want = plain_components([r for r in rows if r[0] is not None])
    got = minhash.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == want[r.doc_id]


def test_links_between_members_unlike_the_smallest(spark, monkeypatch):
    """Families that share a passage, and chains in which the ends are not alike."""
    monkeypatch.setattr(minhash, "BLOCK", 8)
    order = random.Random(4)
    word = lambda: "".join(order.choice("abcdefgh") for _ in range(6))
    shared = [word() for _ in range(60)]
    rows = []
    for family in range(12):
        base = shared + [word() for _ in range(60)]
        for member in range(4):
            rows.append((len(rows), " ".join(base)))
            base = base.copy()
            for at in order.sample(range(60, 120), 2):
                base[at] = word()
    chain = [word() for _ in range(200)]
    for step in range(10):
        rows.append((len(rows), " ".join(chain)))
        chain = chain[8:] + [word() for _ in range(8)]
    rows += [(1000 + i, rows[0][1]) for i in range(50)]
    order.shuffle(rows)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == plain_components(rows)


def test_circulant_signatures_estimate_similarity():
    shingler = minhash.Shingler()
    words = [f"w{i}" for i in range(1000)]
    a, b = shingler.shingles(" ".join(words[:800])), shingler.shingles(" ".join(words[200:]))
    true = len(set(a.tolist()) & set(b.tolist())) / len(set(a.tolist()) | set(b.tolist()))
    same = (minhash.signature(a) == minhash.signature(b)).mean()
    assert abs(same - true) < 0.12


def test_components_of_long_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(1, i) for i in range(200, 260)] + [(7, 7), (9, 8), (8, 9)]
    frame = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in components(frame).collect()}
    assert got == {i: 100 for i in range(100, 161)} | {i: 1 for i in [1, *range(200, 260)]} | {8: 8, 9: 8}


URLS = [None, "", "no host", "http://A.Example.org/es/x", "https://example.org/en/12?q#f", "x://com/fr/", "http://casino-win.net", "a\nb://M.free-bets.example.com?x/fr/", "://", "http://org", "http://xorg/", "http://a.b.org/#/es/", "ftp://É.com/de/é"]


def plain_verdict(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        end = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
        rest = rest[end:]
        path = rest[: min((rest.find(c) for c in "?#" if c in rest), default=len(rest))]
    fits = [(len(h + p), h + p, v) for v, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        return (host, path, *max(fits)[1:])
    return host, path, None, "block" if set(host.split(".")) & set(url_filter.BLOCKED_SITES) else "allow"


@pytest.mark.parametrize("max_bits", [1 << 24, 64])
def test_url_verdicts(spark, root, max_bits):
    """Also with filters so small that they are cut into shards."""
    odd = spark.createDataFrame([(i, u, "h") for i, u in enumerate(URLS)] + [(2, "no host", None), (None, "http://a.com/de/", "x")], "page_id long, url string, host string")
    for pages in (odd, odd.limit(0), spark.read.parquet(f"{root}/pages.parquet")):
        got = [tuple(r) for r in url_filter.judge(pages, max_bits=max_bits).collect()]
        want = [(r.page_id, *plain_verdict(r.url)) for r in pages.select("page_id", "url").collect()]
        assert sorted(got, key=key) == sorted(want, key=key)


@pytest.mark.parametrize("listed", [0, 1, 300, 2000])
def test_cascade_is_exact_over_its_keys(spark, listed):
    keys = spark.range(2000).select(F.concat(F.lit("k"), "id").alias("key"), (F.col("id") < listed).alias("listed"))
    cascade = url_filter.build_cascade(keys)
    wrong = cascade.listed(keys.withColumnRenamed("listed", "wanted"), "key").filter("listed <> wanted")
    assert wrong.count() == 0 and (len(cascade.levels) > 0) == (listed > 0)


def test_pipeline_stages(spark, root, documents):
    """Each stage against plain Python on the rows the one before kept."""
    docs, seen = documents, []
    for name, function in corpus_pipeline.STAGES:
        docs = function(spark, docs, root)
        rows = docs.collect()
        seen.append((name, docs.columns, rows))
        docs = spark.createDataFrame(rows, docs.schema)
    assert [s[0] for s in seen] == ["quality", "exact_dedup", "near_dedup", "pii", "packing"]
    assert all(s[1] == documents.columns for s in seen[:-1])
    texts = [{r.doc_id: r.text for r in s[2]} for s in seen[:-1]]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{root}/labels.parquet").collect()}
    gone = {r.doc_id for r in documents.collect()} - set(texts[0])
    assert all(labels[d] == 0 for d in gone if d in labels) and gone
    assert set(texts[1]) == {d for d, keep, _, kept, _ in plain_groups(list(texts[0].items())) if kept}
    assert set(texts[2]) == {d for d, (_, _, kept) in plain_components(list(texts[1].items())).items() if kept}
    assert set(texts[3]) == set(texts[2]) and any(texts[3][d] != texts[2][d] for d in texts[3])
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = defaultdict(list)
    for r in seen[-1][2]:
        pieces[r.doc_id].append(r)
    assert set(pieces) == set(texts[3])
    for doc_id, own in pieces.items():
        ids = [*tokenizer.encode(texts[3][doc_id], add_special_tokens=False).ids, 2]
        for r in own:
            assert r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids[r.start : r.start + r.length]))
        assert sum(r.length for r in own) == len(ids)


def test_pipeline_on_odd_rows(spark, root, odd_docs, no_docs):
    for docs in (odd_docs.drop("class", "key", "score"), no_docs.drop("class", "key", "score")):
        for _, function in corpus_pipeline.STAGES:
            docs = function(spark, docs, root)
        docs.collect()
