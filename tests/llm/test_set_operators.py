"""Chat formatting, neighbours, mixing, sharding, near-duplicates, url filter and the pipeline."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from helpers import documents, frame, prose
from relsync.llm import chat, common, mixing, neighbors, sharding, simhash, toxicity, urlfilter
from relsync.llm.queries import QUERIES

# --- chat formatting

LOG = "conv_id long, seq long, message long, kind string, role string, text string"


def _fold(events):
    """The log folded one event after the other."""
    order = {k: i for i, k in enumerate(chat.KINDS)}
    texts, roles, gone = {}, {}, set()
    for _, _, message, kind, role, text in sorted(events, key=lambda e: (e[1] is not None, e[1] or 0, order.get(e[3], 0), e[4] is not None, e[4] or "", e[5] or "")):
        if message not in roles and role is not None:
            roles[message] = role
        gone.discard(message)
        if kind == "delta":
            texts[message] = texts.get(message, "") + (text or "")
        elif kind == "delete":
            texts[message] = ""
            gone.add(message)
        else:
            texts[message] = text or ""
    return {m: (roles.get(m, ""), t) for m, t in texts.items() if m not in gone}


def test_events_fold_like_one_after_the_other(spark):
    r, rows = random.Random(9), []
    for c in range(25):
        for _ in range(r.randint(0, 14)):
            rows.append((c, r.choice([None, *range(8)]), r.randint(0, 3), r.choice([*chat.KINDS, None, "odd"]), r.choice(["user", "assistant", None]), r.choice(["", "a", "Bé", None, "### x </turn>\n"])))
    rows += [(None, 1, 1, "message", "user", "no conversation"), rows[0], rows[0]]
    df = spark.createDataFrame([(*e, "x") for e in rows], LOG + ", events string").repartition(5)
    got = defaultdict(dict)
    for m in chat.fold_events(df).collect():
        got[m.conv_id][m.message] = (m.role, m.text)
    by = defaultdict(list)
    for e in rows:
        by[e[0]].append(e)
    assert dict(got) == {c: f for c, es in by.items() if (f := _fold(es))}
    back = {r.conv_id: [tuple(m) for m in r.messages] for r in chat.read_back(chat.format_chats(df)).collect()}
    assert back == {c: [f[m] for m in sorted(f)] for c, es in by.items() if (f := _fold(es))}
    assert chat.format_chats(df.limit(0)).count() == 0


@given(st.lists(st.text(alphabet="\\#</turn>shel :n\n", max_size=30), min_size=1, max_size=8))
@settings(max_examples=15, deadline=None)
def test_texts_survive_the_template(spark, texts):
    df = spark.createDataFrame([(1, i, ("assistant", "us:er\n#")[i % 2], t) for i, t in enumerate(texts)], "conv_id long, message long, role string, text string")
    row = chat.read_back(chat.render(df)).first()
    assert [m.text for m in row.messages] == texts
    assert [m.role for m in row.messages] == [("assistant", "us:er\n#")[i % 2] for i in range(len(texts))]
    assert row.loss_text == "".join(texts[::2])
    assert row.formatted.count(chat.CLOSE) == len(texts)


def test_chat_digests(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "x" * 700), (1, 1, "assistant", "x" * 700), (1, 2, None, None), (2, None, "assistant", ""), (2, 0, "tool", "\\")]
    rows += [(-7, 0, "user", chat.HARD_TEXT), (-7, 1, "assistant", chat.HARD_TEXT)]
    got = {r.conv_id: r for r in chat.digest_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got[1].n_turns == 4 and got[1].loss_chars == 1400 and got[1].loss_sha256 == sha("x" * 1400)
    assert got[1].turns_sha256 == sha("user\nhi\n" + ("assistant\n" + "x" * 700 + "\n") * 2 + "\n\n")
    assert got[2].turns_sha256 == sha("assistant\n\ntool\n\\\n") and got[2].loss_chars == 0
    assert got[-7].loss_sha256 == sha(chat.HARD_TEXT)


# --- nearest neighbours


def test_chi_square_quantile():
    # tabled values
    assert neighbors.chi_square_quantile(0.95, 2) == pytest.approx(5.991, abs=1e-3)
    assert neighbors.chi_square_quantile(0.99, 10) == pytest.approx(23.209, abs=1e-3)


def _exact(vectors, queries, k):
    out = {}
    for q, v in queries:
        seen = sorted({(-float(np.dot(np.float64(v), np.float64(w))), i) for i, w in vectors if i != q})
        out[q] = [(i, -s) for s, i in seen[:k]]
    return out


def test_neighbours_reach_the_recall_and_exact_scores(spark):
    random_ = np.random.default_rng(3)
    centres = random_.normal(size=(6, 24))
    rows = [(i, (centres[i % 6] + 0.7 * random_.normal(size=24)).astype(np.float32) * random_.uniform(0.5, 2)) for i in range(1500)]
    df = spark.createDataFrame([(i, [float(x) for x in v], "x") for i, v in rows], "vec_id long, embedding array<float>, rank string")
    # small cells, so that there are many cells, blocks and rounds
    got = defaultdict(list)
    for r in neighbors.nearest(df, df.where("vec_id % 20 = 0"), k=10, cell=40, sample=300).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    stored = [(i, np.float64(np.float32(v))) for i, v in rows]
    want = _exact(stored, [x for x in stored if x[0] % 20 == 0], 10)
    assert set(got) == set(want) and all(len(v) == 10 for v in got.values())
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 10 * len(want)
    by_id = dict(stored)
    for q, found in got.items():
        assert found == sorted(found, key=lambda x: (-x[1], x[0]))
        assert all(s == pytest.approx(float(by_id[q] @ by_id[i]), abs=1e-12) for i, s in found)


def test_neighbours_hard_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 0.0]) for i in range(40)] + [(i, [0.5, float(i)]) for i in range(40, 50)]
    rows += [(60, None), (61, []), (62, [0.0, 0.0]), (63, [nan, 1.0]), (64, [inf, 1.0]), (65, [1.0, None]), (66, [1.0, 2.0, 3.0]), (None, [9.0, 9.0]), (20, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = defaultdict(list)
    for r in neighbors.nearest(df, df.where("vec_id % 20 = 0"), k=5).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    assert set(got) == {0, 20, 40}
    # ties among equal vectors go to the smallest ids, never to the query's own
    assert [x[1] for x in got[0]] == [1, 2, 3, 4, 5] and [x[1] for x in got[20]] == [0, 1, 2, 3, 4]
    assert [x[1] for x in got[40]] == [49, 48, 47, 46, 45] and [x[0] for x in got[40]] == [1, 2, 3, 4, 5]
    few = neighbors.nearest(df.where("vec_id BETWEEN 40 AND 42"), df.where("vec_id = 40"), k=5).collect()
    assert sorted(r.vec_id for r in few) == [41, 42]
    assert neighbors.nearest(df.limit(0), df, k=5).count() == 0 and neighbors.nearest(df, df.limit(0), k=5).count() == 0
    assert neighbors.nearest(df.where("vec_id >= 60"), df, k=3).where("query_id < 60").count() == 0


# --- mixing


def _targets(sizes, weights, share, limit):
    """Shares by weight, capped; the excess shared again until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, target, open_ = share * sum(sizes.values()), {}, set(names)
    while open_:
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / total > limit * sizes[s]]
        if not over:
            target |= {s: left * weight[s] / total for s in open_}
            break
        for s in over:
            target[s] = limit * sizes[s]
            open_.discard(s)
        left -= sum(target[s] for s in over)
    return target


@pytest.mark.parametrize("share", [0.3, 1.5, 1.95, 2.5])
def test_mix_meets_targets(spark, share):
    rows = documents(60)
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = Counter()
    for _, t, _, s, _ in rows:
        sizes[s] += count(t)
    want = _targets(dict(sizes), [3, 1, 2], share, 2.0)
    df = frame(spark, rows).withColumn("target", F.lit("x")).withColumn("epochs", F.lit(1))
    got = mixing.mix(df, share=share).collect()
    assert len(got) == len(rows)
    taken = Counter()
    for r in got:
        assert r.target == pytest.approx(want[r.source]) and r.source_size == sizes[r.source] and r.taken <= 2 * r["size"]
        taken[r.source] += r.taken
    assert all(taken[s] == int(want[s] + 1e-9) for s in want)
    assert Counter(map(tuple, got)) == Counter(map(tuple, mixing.mix(df.repartition(7), share=share).collect()))
    docs = mixing.mix_documents(df, share=share)
    assert docs.columns == df.columns
    words, longest = Counter(), max(count(t) for _, t, *_ in rows)
    for r in docs.collect():
        assert (r.doc_id, r.text) in {(d, t) for d, t, *_ in rows}
        words[r.source] += count(r.text)
    assert all(abs(words[s] - want[s]) <= longest / 2 + 1 for s in want)
    assert mixing.mix(df.limit(0)).count() == 0 and mixing.mix_documents(df.limit(0)).count() == 0


def test_mix_takes_whole_passes_and_a_prefix_of_the_key_order(spark):
    rows = [(i, prose(10, i), "en", "a" if i % 4 else "b", 0) for i in range(80)]
    got = mixing.mix(frame(spark, rows), weights=[1, 5], share=1.4, limit=3.0).select("*", common.hash_key(F.col("doc_id")).alias("key")).collect()
    for s in "ab":
        levels = [r.taken // 10 for r in sorted((r for r in got if r.source == s), key=lambda r: r.key) if r.taken % 10 == 0]
        assert levels == sorted(levels, reverse=True) and len(set(levels)) <= 2


def test_lookup_gives_the_same_beyond_its_bound(spark, monkeypatch):
    rows = frame(spark)
    plain = Counter(map(tuple, mixing.mix(rows).collect()))
    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    assert Counter(map(tuple, mixing.mix(rows).collect())) == plain


# --- sharding


def test_shards_are_even_gapless_and_stable(spark):
    r = random.Random(5)
    rows = [(i, prose(r.randint(5, 120), i), "en", "s", 0) for i in range(600)] + [(1000 + i, "one text that a third of all rows share " * 3, "en", "s", 0) for i in range(300)]
    df = frame(spark, rows).withColumn("shard", F.lit("x"))
    got = sharding.shard_digest(df, 8).collect()
    size, slots = Counter(), defaultdict(list)
    for x in got:
        size[x.shard] += x.size
        slots[x.shard].append(x.slot)
    assert set(size) == set(range(8)) and max(size.values()) <= 1.05 * min(size.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) <= 1.2 * min(map(len, slots.values()))
    again = sharding.shard_digest(df.repartition(9), 8).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))
    import zlib

    text = {d: t for d, t, *_ in rows}
    assert all(x.text_crc32 == zlib.crc32(text[x.doc_id].encode()) and x.size == len(text[x.doc_id].encode()) + 16 for x in got)
    # small groups stay together
    pair = frame(spark, rows[:300] + [(5000 + d, *x) for d, *x in rows[:300]])
    where = defaultdict(set)
    for x in sharding.assign(pair, 4, grain=4).collect():
        where[x.text].add(x.shard)
    assert sum(len(v) == 1 for v in where.values()) >= 0.9 * len(where)


def test_copies_share_a_shard_unless_they_fit_none(spark):
    r = random.Random(11)
    texts = [(prose(r.randint(5, 120), i), r.choice([1, 1, 2, 3, 9])) for i in range(250)] + [("fits one shard of forty", 20), ("fits none " * 5, 300)]
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(t for t, n in texts for _ in range(n))]
    where, held = defaultdict(set), Counter()
    for x in sharding.assign(frame(spark, rows), 40).collect():
        where[x.text].add(x.shard)
        held[x.shard] += 1
    assert len(rows) / 40 > 20
    assert {t for t, s in where.items() if len(s) > 1} == {"fits none " * 5}
    assert set(held) == set(range(40)) and max(held.values()) <= 1.3 * len(rows) / 40
    # a group of exactly a shard's size is kept whole
    even = frame(spark, [(i, f"text {i % 7}", "en", "s", 0) for i in range(70)])
    assert sorted(r.n for r in sharding.assign(even, 7).groupBy("shard", "text").agg(F.count(F.lit(1)).alias("n")).collect()) == [10] * 7


def test_shards_of_hard_rows(spark):
    df = frame(spark)
    got = sharding.shard_documents(df, 5)
    assert got.columns == [*df.columns, "shard", "slot"]
    assert Counter(tuple(r)[:5] for r in got.collect()) == Counter(documents())
    assert sharding.shard_documents(df.limit(0), 5).count() == 0
    null = sharding.shard_digest(df, 5).where("text_crc32 IS NULL").collect()
    assert [x.size for x in null] == [16]


def test_place_takes_the_greatest_dot_product():
    got = sharding.place(np.array([[4.0, 1], [3, 3], [2, 2], [1, 4], [0, 0]]), 2)
    total, residual, order = np.array([10.0, 10]), np.ones((2, 2)), [0, 3, 1, 2, 4]
    for i in order:
        v = np.array([[4.0, 1], [3, 3], [2, 2], [1, 4], [0, 0]])[i] * 2 / total
        at = int(np.argmax(residual @ v))
        assert got[i] == at
        residual[at] -= v


def test_write_shards(spark, tmp_path):
    df = sharding.shard_documents(frame(spark), 3)
    sharding.write_shards(df, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == df.count()


# --- SimHash near-duplicates


def _fingerprint(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not words:
        return 0
    s = [" ".join(words[i:i + n]) for i in range(max(1, len(words) - n + 1))]
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@pytest.mark.parametrize("n", [1, 3, 5])
def test_fingerprints_equal_the_definition(n, monkeypatch):
    texts = [t for _, t, *_ in documents(8)] + ["one", "one two", "A b\vC\x85d\u00a0e f", "x " * 9]
    assert [simhash.fingerprint(t, n) for t in texts] == [_fingerprint(t, n) for t in texts]
    monkeypatch.setattr(simhash, "PIECE", 16)
    texts = [t for t in texts if t is None or len(t) < 10_000]
    assert [simhash.fingerprint(t, n) for t in texts] == [_fingerprint(t, n) for t in texts]


def _roots(nodes, linked):
    root = {x: x for x in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {x: find(x) for x in nodes}


@pytest.mark.parametrize("bits", [0, 1, 2, 3])
def test_links_connect_what_brute_force_connects(spark, bits):
    r, fps = random.Random(bits), set()
    for _ in range(14):
        x = r.getrandbits(64)
        for _ in range(r.randint(1, 8)):  # chains of small steps
            fps.add(x)
            for _ in range(r.randint(1, 3)):
                x ^= 1 << r.randrange(64)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    apart = lambda a, b: bin((a ^ b) & (1 << 64) - 1).count("1")
    edges = simhash.links(df, bits).collect()
    assert all(0 < apart(e.a, e.b) <= bits for e in edges)
    want = _roots(signed, lambda a, b: apart(a, b) <= bits)
    got = {x: x for x in signed} | {e.node: e.root for e in simhash.components(simhash.links(df, bits)).collect()}
    assert got == want


def test_components_of_long_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 100)] + [(5, 5), (7, 6)]
    got = {r.node: r.root for r in simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(201)} | {1000 + i: 1000 for i in range(100)}
    assert simhash.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_duplicates_and_deduplication(spark):
    rows = documents(20)
    for i in range(12):
        words = prose(400, i).split()
        rows.append((300 + i, " ".join(words).upper(), "en", "s0", 0))
        words[random.Random(i).randrange(400)] = "changed"
        rows.append((200 + i, "\n".join(words), "en", "s0", 0))
    fps = {t: _fingerprint(t, 3) for _, t, *_ in rows}
    root = _roots(set(fps.values()), lambda a, b: (a ^ b).bit_count() <= 2)
    smallest = defaultdict(list)
    for d, t, *_ in rows:
        smallest[root[fps[t]]].append(d)
    least = {k: min((x for x in v if x is not None), default=None) for k, v in smallest.items()}
    df = frame(spark, rows).withColumn("fingerprint", F.lit("x")).withColumn("fp", F.lit(1))
    got = Counter(map(tuple, simhash.near_duplicates(df).collect()))
    assert got == Counter((d, format(fps[t], "016x"), least[root[fps[t]]]) for d, t, *_ in rows)
    kept = simhash.deduplicate(df).collect()
    assert Counter(root[fps[r.text]] for r in kept) == Counter(dict.fromkeys(smallest, 1))
    assert all(r.doc_id == least[root[fps[r.text]]] for r in kept)
    assert simhash.near_duplicates(df.limit(0)).count() == 0 and simhash.deduplicate(df.limit(0)).count() == 0


# --- url filter


def _judge(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    host = re.sub("[A-Z]", lambda m: m.group().lower(), host)
    fits = [(len(h + p), v == "block", h + p) for v, h, p in urlfilter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fits, default=(0, 0, None))[2]


def test_urls_hosts_paths_and_rules(spark):
    urls = [
        None, "", "no scheme/net/", "http://example.net/en/1", "HTTP://WWW.Example.NET/en", "https://a.example.com/de/x?y#z", "http://x.org/fr/", "http://x.org",
        "ftp://net", "http://net/", "http://notnet/", "http://example.net?x=/en/", "http://h#/p", "x://y://z/", "://", "http://sub.net//a", "http://user@b.net:80/q", "http://É.net/ä",
    ]
    df = spark.createDataFrame([(i, u, None, "x", "x") for i, u in enumerate([*urls, *urls])], "page_id long, url string, html string, host string, verdict string")
    for r in urlfilter.judge_urls(df, urlfilter.RULES).collect():
        host, path, rule = _judge(urls[r.page_id % len(urls)])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        want = {v for v, h, p in urlfilter.RULES if h + p == rule} or {"allow"}
        assert {r.verdict} == want
    assert urlfilter.judge_urls(df.limit(0), urlfilter.RULES).count() == 0
    assert {r.verdict for r in urlfilter.judge_urls(df, []).collect()} == {"allow"}


def _rank(edges, seeds, rounds=20):
    """Received personalised PageRank by plain iteration."""
    degree, total = Counter(), sum(seeds.values())
    for (a, _), n in edges.items():
        degree[a] += n
    wave = {h: 0.15 * w / total for h, w in seeds.items()} if total else {}
    received = Counter()
    for _ in range(rounds):
        nxt = Counter()
        for (a, b), n in edges.items():
            if a in wave:
                nxt[b] += 0.85 * wave[a] * n / degree[a]
        for h, x in nxt.items():
            received[h] += x
        wave = nxt
    return received


def test_links_spread_trust_and_distrust(spark):
    r = random.Random(8)
    hosts = ["bad.net", "worse.net", "ok.org", "fine.org"] + [f"h{i}.com" for i in range(12)]
    pages, edges, allowed, blocked = [], Counter(), Counter(), Counter()
    for i in range(120):
        h, to = r.choice(hosts), [r.choice(hosts) for _ in range(r.randint(0, 3))]
        path = r.choice(["/fr/1", "/en/2"])
        html = "".join(f'<a class=x HREF = "{r.choice(["http://", "//"])}{t.upper()}/p">t</a><a href="/local">l</a>' for t in to)
        pages.append((i, f"https://{h}{path}", html if to else r.choice([None, ""])))
        for t in to:
            if t != h:
                edges[h, t] += 1
        rule = _judge(pages[-1][1])[2]
        if rule == "net/":
            blocked[h] += 1
        elif rule == "org/fr/":
            allowed[h] += 1
    trust, distrust = _rank(edges, allowed), _rank(Counter({(b, a): n for (a, b), n in edges.items()}), blocked)
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    seen = set()
    for x in urlfilter.judge_urls(df, urlfilter.RULES).collect():
        assert x.trust == pytest.approx(trust[x.host], abs=1e-7) and x.distrust == pytest.approx(distrust[x.host], abs=1e-7)
        if x.rule is None:
            assert x.verdict == ("block" if distrust[x.host] > trust[x.host] else "allow")
            seen.add(x.verdict)
    assert seen == {"allow", "block"}
    import duckdb

    con = duckdb.connect()
    table = df.toArrow()
    con.register("pages", table)
    cur = con.execute(urlfilter.oracle())
    want = sorted(map(str, cur.fetchall()))
    assert sorted(str(tuple(x)) for x in urlfilter.judge_urls(df, urlfilter.RULES).select("page_id", "host", "path", "rule", "verdict").collect()) == want


# --- the pipeline


def test_stages_on_hard_rows_and_empty_tables(spark, tmp_path):
    sf = str(tmp_path)
    spark.createDataFrame([(1, 0, 0), (2, 1, 1), (None, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([(1, prose(30, 1)), (2, None)], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    frame(spark).write.parquet(f"{sf}/documents.parquet")
    for docs in (frame(spark).withColumn("__fp", F.lit("x")), frame(spark).limit(0).withColumn("__fp", F.lit("x"))):
        n = docs.count()
        for name, stage in corpus_pipeline.STAGES:
            docs = common.cut(stage(spark, docs, sf))
            assert set(frame(spark).columns) <= set(docs.columns), name
        assert (docs.count() > 0) == (n > 0)
        assert {"shard", "slot"} <= set(docs.columns)
    out = corpus_pipeline.run(spark, sf)
    assert out.columns == [*frame(spark).columns, "shard", "slot"]


def test_pipeline_equals_its_stages_one_by_one(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = docs.collect()
    model = toxicity.fit(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    scores = toxicity.score_texts([r.text for r in rows], model)
    kept = [r for r, s in zip(rows, scores, strict=True) if s < 0.5]
    fps = {r.doc_id: _fingerprint(r.text, 3) for r in kept}
    root = _roots(set(fps.values()), lambda a, b: (a ^ b).bit_count() <= 2)
    least = {}
    for d, f in fps.items():
        least[root[f]] = min(d, least.get(root[f], d))
    kept = [r for r in kept if least[root[fps[r.doc_id]]] == r.doc_id]
    split = lambda t: re.findall(r"[0-9a-z\x80-\U0010ffff]+", t.lower())
    items = [(split(r.text), r.item_id) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    holds = lambda t: any(" " + " ".join(q) + " " in " " + " ".join(split(t)) + " " for q, _ in items)
    got = Counter(r.doc_id for r in corpus_pipeline.run(spark, sf).collect())
    # mixing may leave documents out, but brings in none that an earlier stage dropped
    assert set(got) <= {r.doc_id for r in kept}
    assert not any(holds(r.text) for r in kept if r.doc_id in got)
    clean = [r for r in kept if not holds(r.text)]
    mixed = Counter(r.doc_id for r in mixing.mix_documents(spark.createDataFrame(clean, docs.schema), weights=[3, 1, 2], share=1.5, limit=2.0).collect())
    assert got == mixed


def test_queries_need_no_columns_beyond_their_contract(spark):
    sf = "/root/testdata/sf0.001"
    assert set(QUERIES) == {f for f in QUERIES if re.match(r"op([1-9]|1[0-3])_", f)} and len(QUERIES) == 13
    got = QUERIES["op8_simhash_near_duplicates"](spark, sf)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
