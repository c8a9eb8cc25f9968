import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
import xxhash

from pagemill.llm import common, media, mixing, pii, sharding, simhash, urlfilter

from . import cases

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- sharding ---------------------------------------------------------------------------------------------------


def test_shards_have_near_equal_bytes_and_gapless_slots(spark):
    data = cases.rows()
    got = sharding.shard_by_splitters(cases.table(spark), 8).toPandas()
    assert len(got) == len(data)
    sizes = Counter((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in data)
    assert Counter((None if pd.isna(a) else int(a), b, c) for a, b, c in zip(got.doc_id, got["size"], got.text_crc32)) == sizes
    total, largest = got["size"].sum(), got["size"].max()
    assert all(abs(s - total / 8) <= 2 * largest for s in got.groupby("shard")["size"].sum())
    for _, g in got.groupby("shard"):
        assert sorted(g["slot"]) == list(range(len(g)))


@pytest.mark.parametrize("ranges", [2, 7, 64])
def test_shards_follow_the_key_order(spark, ranges):
    """Shards and slots are a plain sort by key, cut where the bytes are near equal."""
    data = [(i, random.Random(i).choice(["x", "yy", f"{i} " * 50]), "en", "a", 1) for i in range(500)]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    got = sharding.shard_by_splitters(df, 4, ranges=ranges, seed=ranges).toPandas().sort_values(["shard", "slot"])
    order = sorted(data, key=lambda r: (int(hashlib.md5(r[1].encode()).hexdigest()[:15], 16), r[0]))
    assert got.doc_id.tolist() == [r[0] for r in order]
    total = sum(len(r[1]) + 1 for r in data)
    assert all(abs(b - total / 4) <= 2 * 201 for b in got.groupby("shard")["size"].sum())


def _slim(spark, keys, size=10):
    return spark.createDataFrame([(k, 0, i, size) for i, k in enumerate(keys)], "key long, tie long, row long, size long")


def test_splitters_decide_where_a_shard_ends(spark, monkeypatch):
    slim = _slim(spark, range(5000))
    splitters, sums = sharding.split(slim, 4, 50000, 5000, ranges=32, tolerance=0.01)
    first = [s for s, _, _ in splitters]
    ends = [first[int(r) - 1] for r in sums.groupby("shard")["range"].min()[1:]]
    for k, end in enumerate(ends, 1):  # the shard begins at a splitter, near its part of the bytes
        assert abs(end * 10 - k * 12500) <= 0.01 * 12500 + 10
    # other splitters, other borders: with coarse ones and no need to subdivide, the borders are those of the ranges
    monkeypatch.setattr(sharding, "_quantiles", lambda sample, parts: [(1000, 0, 1000), (2600, 0, 2600), (4000, 0, 4000)])
    _, sums = sharding.split(slim, 4, 50000, 5000, ranges=4, tolerance=10)
    assert sums.b.tolist() == [10000, 16000, 14000, 10000] and sums.shard.tolist() == [0, 1, 2, 3]


def test_identical_rows_are_spread(spark):
    splitters, sums = sharding.split(_slim(spark, [7] * 6000 + list(range(3000))), 8, 90000, 9000, ranges=64)
    assert sums.n.max() <= sharding.OVERFULL * 9000 / 64 and len(splitters) >= 64
    assert all(abs(b - 90000 / 8) <= 20 for b in sums.groupby("shard").b.sum())
    same = spark.createDataFrame([(1, "same text")] * 3000, "doc_id long, text string")
    got = sharding.shard_by_splitters(same, 8, ranges=16).toPandas()
    assert got.groupby("shard").size().tolist() == [375] * 8 and all(sorted(g) == list(range(375)) for _, g in got.groupby("shard").slot)


# --- simhash ----------------------------------------------------------------------------------------------------


def _print(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def _components(prints):
    """Smallest id of each component over links of 3 bits, by comparing all pairs."""
    keys = sorted(set(prints.values()))
    parent = {k: k for k in keys}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if (a ^ b).bit_count() <= 3:
                parent[find(a)] = find(b)
    least = {}
    for d, p in prints.items():
        if d is not None:
            least[find(p)] = min(least.get(find(p), d), d)
    return {d: least.get(find(p)) for d, p in prints.items()}


def test_simhash_equals_brute_force(spark):
    got = simhash.simhash_components(cases.table(spark)).toPandas()
    data = cases.rows()
    assert len(got) == len(data)
    prints = {r[0]: _print(r[1]) for r in data if r[0] is not None}
    want = _components(prints)
    for d, f, c in zip(got.doc_id, got.fingerprint, got.component_id):
        if not pd.isna(d):
            assert f == f"{prints[d]:016x}" and c == want[d]


def test_simhash_bands_follow_the_count():
    assert [simhash.agreeing_bands(n, 3) for n in (0, 10**8, 10**10, 10**12, 10**15)] == [1, 1, 2, 3, 5]


@pytest.mark.parametrize("agree", [1, 2, 3])
def test_simhash_links_chains_and_dense_groups(spark, agree):
    rng = np.random.default_rng(3)
    centres = rng.integers(0, 2**63, 30, dtype=np.uint64)
    near = [int(c) for c in centres]
    for c in centres:
        x = int(c)
        for _ in range(12):  # a chain: each three bits from the last
            for b in rng.choice(64, 3, replace=False):
                x ^= 1 << int(b)
            near.append(x)
    dense = [int(centres[0]) ^ (1 << a) ^ (1 << b) for a in range(40) for b in range(a)]
    values = sorted(set(near + dense))
    signed = [v - 2**64 if v >= 2**63 else v for v in values]
    links = simhash.simhash_links(spark.createDataFrame([(v,) for v in signed], "fp long"), agree=agree)
    assert links.count() < math.comb(3 + agree, agree) * len(values)  # a forest a choice of bands
    root = {r["node"]: r["root"] for r in simhash.components(links).collect()}
    want = _components(dict(enumerate(values)))
    groups = defaultdict(set)
    for i, v in enumerate(signed):
        groups[want[i]].add(root.get(v, v))
    assert all(len(g) == 1 for g in groups.values()) and len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_parts_of_a_bucket_share_its_work(monkeypatch):
    """Each part compares its own base rows with all rows; together they link what the whole does."""
    rng = np.random.default_rng(1)
    prints = rng.integers(0, 2**14, 4000, dtype=np.uint64)
    prints = prints[np.argsort(np.bitwise_count(prints), kind="stable")]
    group, part, seen = np.zeros(4000, np.int64), rng.integers(0, 4, 4000), []
    count = np.bitwise_count
    monkeypatch.setattr(simhash, "TILE", 64)
    monkeypatch.setattr(np, "bitwise_count", lambda x: (seen.append(x.size if x.ndim == 2 else 0), count(x))[1])
    whole = simhash.forest_of(group, prints, np.ones(4000, bool), 1)
    work = [sum(seen)]
    joined = simhash._Forest(4000)
    for k in range(4):
        seen.clear()
        joined.link(*simhash.forest_of(group, prints, part == k, 1))
        work.append(sum(seen))
    want = simhash._Forest(4000)
    want.link(*whole)
    rows = np.arange(4000)
    assert (joined.roots(rows) == want.roots(rows)).all()
    assert max(work[1:]) <= 0.6 * work[0]


def test_hot_keys_go_out_as_a_broadcast(spark):
    rows = spark.createDataFrame([(i, 0 if i % 3 else i) for i in range(6000)], "id long, k long")
    table = rows.groupBy("k").count().withColumnRenamed("count", "n").withColumn("v", -__import__("pyspark").sql.functions.col("k")).where("k != 9")
    got = {r["id"]: r["v"] for r in common.attach(rows, table, "k", 6000).collect()}
    assert got == {i: None if i == 9 else (0 if i % 3 else -i) for i in range(6000)}


def test_tiles_skip_nothing_that_links():
    rng = np.random.default_rng(0)
    prints = rng.integers(0, 2**12, 3000, dtype=np.uint64)
    order = np.argsort(np.bitwise_count(prints), kind="stable")
    prints, group = prints[order], np.zeros(3000, np.int64)
    child, root = simhash.forest_of(group, prints, np.ones(3000, bool), 1)
    assert len(child) == len(set(child.tolist()))
    for i in range(0, 3000, 37):
        near = np.flatnonzero(np.bitwise_count(prints ^ prints[i]) <= 1)
        top = dict(zip(child.tolist(), root.tolist(), strict=True))
        assert len({top.get(int(j), int(j)) for j in near}) == 1


def test_dedup_stage_keeps_one_of_each(spark):
    kept = simhash.stage_dedup(spark, cases.table(spark), "")
    assert kept.columns == cases.table(spark).columns
    ids = [r["doc_id"] for r in kept.collect()]
    want = _components({r[0]: _print(r[1]) for r in cases.rows() if r[0] is not None})
    assert Counter(i for i in ids if i is not None) == Counter({c: 1 for c in set(want.values())})


def _shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_dedup_stage_links_all_of_similarity_four_fifths(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    texts, shared = [], [word() for _ in range(30)]
    for _ in range(60):
        words = [word() for _ in range(rng.choice([3, 8, 40, 150]))] + shared * rng.randrange(2)
        texts.append(" ".join(words))
        for _ in range(rng.randrange(4)):
            for _ in range(rng.randrange(4)):
                words[rng.randrange(len(words))] = word()
            texts.append(" ".join(words))
    sets, parent, near = [_shingles(t) for t in texts], list(range(len(texts))), set()

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if 5 * len(a & sets[j]) >= 4 * len(a | sets[j]):
                near.add((j, i))
                parent[max(find(i), find(j))] = min(find(i), find(j))
    assert any(sets[i] != sets[j] and 5 * len(sets[i] & sets[j]) < 4.5 * len(sets[i] | sets[j]) for i, j in near)
    kept = simhash.stage_dedup(spark, spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "")
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({find(i) for i in range(len(texts))})


def test_dedup_stage_tells_texts_under_one_id_apart(spark):
    a, b, c = ("one two three four five six", "red green blue black white grey", "x y z u v w")
    stage = lambda data: sorted(tuple(r) for r in simhash.stage_dedup(spark, spark.createDataFrame(data, "doc_id long, text string"), "").collect())
    assert stage([(7, a), (7, b), (3, b)]) == [(3, b), (7, a)]
    assert stage([(7, a), (7, c), (7, c)]) == sorted([(7, a), (7, c)])


def test_similar_in_compares_exactly_at_four_fifths():
    a = np.arange(9, dtype=np.int64)
    child, root = simhash.similar_in([a[:4], a[:5], a[[0, 1, 2, 3, 7]], a[:9]], np.ones(4, bool))
    assert {frozenset(x) for x in zip(child.tolist(), root.tolist(), strict=True)} == {frozenset((1, 0)), frozenset((2, 0))}


# --- mixing -----------------------------------------------------------------------------------------------------


def _targets(sizes):
    names = sorted([s for s in sizes if s is not None]) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, fixed = 1.5 * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        left = total - sum(fixed.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free} if free else {}
        over = [s for s in free if share[s] > 2 * sizes[s]]
        if not over:
            return fixed | share
        fixed |= {s: 2.0 * sizes[s] for s in over}


def _apportion(targets, block):
    seats = max(1, round(sum(targets.values()) / block))
    won = Counter()
    order = sorted([s for s in targets if s is not None]) + [None]
    for _ in range(seats):
        won[max((s for s in targets if targets[s] > 0), key=lambda s: (targets[s] / (2 * won[s] + 1), -order.index(s)))] += 1
    return won


def test_mix_follows_targets_and_apportionment(spark):
    data = cases.rows()
    got = mixing.mix_sources(cases.table(spark)).toPandas()
    sizes = Counter()
    for r in data:
        sizes[r[3]] += len(WORD.findall(r[1] or ""))
    want = _targets(sizes)
    blocks = _apportion(want, mixing.BLOCK)
    assert len(got) == len(data)
    for source, g in got.groupby(got.source.astype(object).where(got.source.notna(), "null")):
        s = None if source == "null" else source
        assert g.source_size.iloc[0] == sizes[s] == g["size"].sum()
        assert g.target.iloc[0] == pytest.approx(want[s])
        assert g.taken.sum() == min(blocks[s] * mixing.BLOCK, 2 * sizes[s])
        assert abs(g.taken.sum() - want[s]) <= mixing.BLOCK * 2
        assert (g.taken <= 2 * g["size"]).all()
    again = mixing.mix_sources(cases.table(spark).repartition(5)).toPandas()
    assert Counter(zip(again["size"], again.taken)) == Counter(zip(got["size"], got.taken))


def test_mix_numbers_rows_that_are_alike(spark):
    """Half of all rows without an id and with one text; two texts under one id are told apart, in any order of the rows."""
    data = [(None, "a b c", "en", "x", 5)] * 400 + [(i, f"w{i} " * (i % 9 + 1), "en", "x" if i % 2 else "y", 1) for i in range(400)] + [(7, "one two", "en", "x", 1), (7, "two one", "en", "x", 1)] * 30
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    got = mixing.mix_sources(df).toPandas()
    again = mixing.mix_sources(df.orderBy("n_chars", "text").repartition(3)).toPandas()
    rows = lambda x: Counter(zip(x.doc_id.fillna(-1), x["size"], x.source, x.taken))
    assert rows(got) == rows(again) and len(got) == len(data)
    for _, g in got.groupby("source"):
        assert abs(g.taken.sum() - g.target.iloc[0]) <= 2 * mixing.BLOCK
    text = lambda out: Counter((r["doc_id"], r["text"]) for r in out.collect())
    assert text(mixing.stage_mix(spark, df, "")) == text(mixing.stage_mix(spark, df.orderBy("text").repartition(5), ""))


def test_quotas_by_shard_add_up(spark):
    targets = {"a": 700.0, "b": 133.0, "c": 90.0, "d": 16.0}
    df = spark.createDataFrame([("s" + k, k, 1000, v) for k, v in targets.items()], "skey string, source string, source_size long, target double")
    for r in mixing.quotas(df, 10, 4).collect():
        ends = list(r["upto"])
        assert ends == sorted(ends)
        for k, end in enumerate(ends, 1):
            part, won = round(round(sum(targets.values()) / 10) * k / 4), Counter()
            for _ in range(part):
                won[max(targets, key=lambda s: (targets[s] / (2 * won[s] + 1), s == min(targets)))] += 1
            assert abs(end - won[r["skey"][1:]]) <= 1


def test_mix_stage_repeats_and_cuts(spark):
    out = mixing.stage_mix(spark, cases.table(spark), "")
    assert out.columns == cases.table(spark).columns
    words = Counter()
    for r in out.collect():
        assert r["n_chars"] == len(r["text"])
        words[r["source"]] += len(WORD.findall(r["text"]))
    taken = mixing.mix_sources(cases.table(spark)).groupBy("source").sum("taken").collect()
    assert words == Counter({r[0]: r[1] for r in taken if r[1]})


# --- url filters ------------------------------------------------------------------------------------------------


def _judge(url):
    at = (url or "").find("://")
    rest = url[at + 3 :] if at >= 0 else ""
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [(h + p, v) for h, p, v in (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block"))
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        rule, verdict = max(fits, key=lambda x: len(x[0]))
        return host, path, rule, verdict
    own = any(re.search(rf"(?:^|[.-]){re.escape(w)}[.-]", host, re.S) for w in urlfilter.OWN)
    return host, path, None, "block" if own else "allow"


def test_urls_against_brute_force(spark):
    rng = random.Random(5)
    hosts = ["example.com", "www.Example.com", "notexample.com", "a.net", "net", "x.casino-win.org", "spam-farm.example.org", "com", "é.com", "a_b.com", "pills.net", "wwwexample.com", ".com", "a.b:80"]
    urls = [f"{rng.choice(['http', 'https', ''])}://{rng.choice(hosts)}{rng.choice(['', '/', '/en/', '/en', '/EN/', '/es/1', '/fr/?a', '/en/#x', '?q=/en/', '#t', '/é/en/'])}" for _ in range(800)]
    urls += [None, "", "no scheme", "://", "a://b://c/en/", "http://example.com/en/" + "x" * 30000, "http://a\nb.com/\n"] + urls[:3]
    df = spark.createDataFrame([(i, u, 1, "t") for i, u in enumerate(urls)], "page_id long, url string, host int, tokens string")
    got = {r["page_id"]: tuple(r)[1:] for r in urlfilter.filter_urls(df).collect()}
    assert got == {i: _judge(u) for i, u in enumerate(urls)}


def test_thousands_of_rules_against_brute_force(spark):
    rng = random.Random(6)
    hosts = [f"{rng.choice('abcdefgh')}{rng.randrange(300)}.{rng.choice(['org', 'net', 'пример.рф', 'é'])}" for _ in range(900)]
    listed = list({(h, p): (h, p, rng.choice(["allow", "block"])) for h in [*hosts, "пример.рф", "é", "org"] for p in ("/", rng.choice(["/x/", "/x/y", "/é/"]))}.values())
    rules = [urlfilter.rule_of(*r) for r in listed] + [urlfilter.word_rule(w) for w in ("h1", "g2")] + [("any query", r"(?s)secret", [], "block", True)]
    urls = [f"http://{rng.choice(['', 'www.', 'h1.'])}{rng.choice(hosts)}{rng.choice(['/', '/x/', '/x/y/z', '/é/', '', '/secret'])}" for _ in range(3000)]
    df = spark.createDataFrame(list(enumerate(urls)) + [(-1, urls[0])] * 500, "page_id long, url string")
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in urlfilter.filter_urls(df, urlfilter.rule_table(spark, rules)).collect()}
    for i, u in enumerate(urls):
        host, path, *_ = _judge(u)
        fits = [(h + p, v) for h, p, v in listed if (host == h or host.endswith("." + h)) and path.startswith(p)] + [("any query", "block")] * ("secret" in path)
        want = min(fits, key=lambda x: (-len(x[0]), x[0])) if fits else (None, "block" if re.search(r"(?:^|[.-])(?:h1|g2)[.-]", host) else "allow")
        assert got[i] == want, u
    assert got[-1] == got[0]
    assert urlfilter.filter_urls(df, urlfilter.rule_table(spark, [])).where("rule is null and verdict = 'allow'").count() == df.count()


def test_rules_are_filed_under_their_rarest_token(spark):
    df = spark.createDataFrame([("a.example.com/en/",)] * 5 + [("b.example.com/de/",)], "canonical string")
    rules = urlfilter.rule_table(spark, [*(urlfilter.rule_of(*r) for r in urlfilter.LISTED), urlfilter.rule_of("пример.рф", "/", "block")])
    filed = {r["rule"]: r["token"] for r in urlfilter.filed_rules(df, rules).collect()}
    assert filed["example.com/en/"] == "en" and filed["com/"] == "com" and filed["net/es/"] == "es" and filed["пример.рф/"] == ""


# --- personal data ----------------------------------------------------------------------------------------------


def _base(text):
    out = []
    for kind, pattern in (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and max(map(int, m[0].split("."))) > 255:
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def test_base_spans_against_brute_force(spark):
    rng = random.Random(1)
    texts = [None, "", " ", "4111 1111 1111 1111; " * 3000, "a@b.c " * 5000, "a" * 30000, "1" * 30000, "1 " * 15000, "a.b@c.d.e_f@g.h", "1.2.3.4.5.6.7.8", "999.1.1.1", "+1 (564) 555-4526.", "x4111 1111 1111 1111y", "a@b.c@d.e", "00012.1.1.255", "😀 a@b.c"]
    for alphabet in ("0123456789.+-@ ()aZ%_é😀\n", "0123456789.+ @a"):
        texts += ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 60))) for _ in range(3000)]
    got = pii.personal_data(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).toPandas().set_index("doc_id")
    for i, t in enumerate(texts):
        want = _base(t)
        assert got.loc[i, "base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest(), t
        assert [got.loc[i, f"n_{k}"] for k in pii.KINDS] == [sum(w.startswith(k) for w in want) for k in pii.KINDS]
        spans = got.loc[i, "spans"].split(",") if got.loc[i, "spans"] else []
        assert set(want) <= set(spans) and got.loc[i, "private"] == bool(spans)
        assert spans == sorted(spans, key=lambda x: (pii.ALL.index(x.split(":")[0]), int(x.split(":")[1])))


def test_patterns_find_unseen_identifiers(spark):
    long = "averyveryverylongwordthatexceedsfortycharacters"
    rows = [(i, f"some words then write to mail: user{i}@site.org now {long}: 10.0.0.{i} end") for i in range(30)] + [(50, "please write to mail: user51@localhost today"), (51, "there were 12345 sheep")]
    got = {r["doc_id"]: r["spans"] for r in pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[50] == f"email:{rows[30][1].index('user51')}:{rows[30][1].index(' today')}" and got[51] == ""
    # a short token, and one behind a long word, are instances like any other; secrets are seeds of their own
    more = [(60, f"{long}: 7x"), (61, "sheep 7x"), *((70 + i, f'token = "{i:032x}a1" x') for i in range(6)), (80, 'token = "shorter9"')]
    got = {r["doc_id"]: r["spans"] for r in pii.personal_data(spark.createDataFrame(rows + more, "doc_id long, text string")).collect()}
    assert got[60] == f"ip:{len(long) + 2}:{len(long) + 4}" and got[61] == "" and got[70] == "secret:9:43" and got[80] == "secret:9:17"


def test_spans_against_a_plain_bootstrap(spark):
    """The whole method in plain Python: seeds, patterns, the scored graph, and what it adds."""
    rng = random.Random(9)
    values = [lambda: f"u{rng.randrange(99)}@x{rng.randrange(9)}.org", lambda: f"10.{rng.randrange(99)}.0.{rng.randrange(260)}", lambda: f"+1 555 {rng.randrange(10**6, 10**7)}", lambda: str(rng.randrange(10**4)), lambda: f"user{rng.randrange(99)}@host", lambda: "none"]
    heads = {"mail: ": 0, "server ": 1, "call ": 2, "page ": 3, "id=": 3, "über ": 5}
    texts = ["; ".join(head + (values[kind] if rng.random() < 0.93 else rng.choice(values))() for head, kind in rng.choices(list(heads.items()), k=rng.randrange(1, 8))) for _ in range(300)]
    instances = []
    for i, t in enumerate(texts):
        base = [(k, int(a), int(b)) for k, a, b in (x.split(":") for x in _base(t))]
        raw = {k: [m.span() for m in re.finditer(p, t)] for k, p in (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"))}
        loose = [m.span() for m in re.finditer(r"(?<![A-Za-z0-9@._%+-])(?=[A-Za-z._%+-]*[0-9@])[A-Za-z0-9@._%+-]*[A-Za-z0-9]", t)]

        def pattern(a, spans):
            gap = t[max([e for _, e in spans if e <= a], default=0) : a]
            m = re.search(r"(?<![^\W\d_])([^\W\d_]+(?:[^\w]|_){1,4})\Z", gap)
            return re.sub(r"\s+", " ", m[1]).lower() if m else None

        instances += [(i, a, b, k, t[a:b].lower(), pattern(a, raw[k])) for k, a, b in base]
        instances += [(i, a, b, None, t[a:b].lower(), pattern(a, loose)) for a, b in loose if not any(x < b and a < y for _, x, y in base)]
    edges = defaultdict(lambda: [0, None])
    for _, _, _, k, v, p in instances:
        if p:
            edges[p, v][0] += 1
            edges[p, v][1] = max(filter(None, (edges[p, v][1], k)), default=None)
    seeds = {(v, k): 1.0 for (_, v), (_, k) in edges.items() if k}
    belief, before = seeds, None
    for _ in range(50):
        weight, whole = Counter(), Counter()
        for (p, v), (n, _) in edges.items():
            whole[p] += n
            for kind in pii.KINDS:
                weight[p, kind] += n * belief.get((v, kind), 0.0)
        score = {x: w / (whole[x[0]] + 1) for x, w in weight.items() if w}
        if before is not None and max(abs(score.get(x, 0) - before.get(x, 0)) for x in {*score, *before}) < 1e-3:
            break
        before, belief, known = score, dict(seeds), {v for v, _ in seeds}
        for (p, v), (_, k) in edges.items():
            for kind in pii.KINDS:
                if k is None and v not in known and score.get((p, kind), 0) >= 0.5:
                    belief[v, kind] = max(belief.get((v, kind), 0), score[p, kind])
    support = Counter((p, k) for (p, _), (_, k) in edges.items() if k)
    best = {}
    for (p, kind), x in score.items():
        if x >= 0.8 and support[p, kind] >= 5:
            best[p] = max(best.get(p, (0, "")), (x, kind))
    want = {i: set() for i in range(len(texts))}
    for i, a, b, k, _, p in instances:
        if k or p in best:
            want[i].add(f"{k or best[p][1]}:{a}:{b}")
    got = {r["doc_id"]: set(filter(None, r["spans"].split(","))) for r in pii.personal_data(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert got == want and any(len(want[i]) > len(_base(t)) for i, t in enumerate(texts))


def test_pii_stage_masks(spark):
    data = [(1, "card 4111 1111 1111 1111 and a@b.c", "en", "a", 34), (2, None, None, None, None), (3, "clean", "en", "a", 5)]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in pii.stage_pii(spark, df, "").collect()}
    assert got == {1: ("card [CARD] and [EMAIL]", 23), 2: (None, None), 3: ("clean", 5)}
    long = "é 4111 1111 1111 1111 a@b.c +1 555 123 4567, 10.0.0.1 x, "
    many = spark.createDataFrame([(1, long * 1000, "en", "a", 1)] * 2, "doc_id long, text string, lang string, source string, n_chars long")
    assert {r["text"] for r in pii.stage_pii(spark, many, "").collect()} == {"é [CARD] [EMAIL] [PHONE], [IP] x, " * 1000}
    assert pii.stage_pii(spark, cases.table(spark), "").count() == len(cases.rows())


# --- media ------------------------------------------------------------------------------------------------------


def test_text_round_trip(spark):
    data = cases.rows()
    got = media.text_media(cases.table(spark)).toPandas()
    assert len(got) == len(data)
    want = Counter()
    for r in data:
        raw = (r[1] or "").encode()
        padded = raw.ljust(max(64, -(-len(raw) // 64) * 64), b"\0")
        want[(len(raw), len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-64:]))] += 1
    assert Counter(zip(got.n_bytes, got.payload_bytes, got.payload_sha256, got.tail_crc32)) == want
    assert got.groupby("payload_sha256").feature.nunique().max() == 1


def test_stored_form_reads_back():
    for text in ("", "é", "x" * 1000):
        pixels = media.decode(media.store_text(text))
        assert pixels.tobytes().rstrip(b"\0") == text.encode() and pixels.shape[1] == 64


def test_netpbm_and_bmp_decode():
    grey = np.arange(12, dtype=np.uint8).reshape(3, 4)
    assert (media.decode(b"P2\n# note\n4 3\n255\n" + b" ".join(str(x).encode() for x in grey.ravel())) == grey).all()
    assert (media.decode(b"P5 4 3 255 " + grey.tobytes()) == grey).all()
    assert (media.decode(b"P1\n2 2\n10\n01") == np.array([[0, 255], [255, 0]])).all()
    assert (media.decode(b"P4\n2 2\n\x80\x40") == np.array([[0, 255], [255, 0]])).all()
    rgb = np.arange(18, dtype=np.uint8).reshape(2, 3, 3)
    assert (media.decode(b"P6\n3 2\n255\n" + rgb.tobytes()) == rgb).all()
    rows = b"".join(rgb[y, :, ::-1].tobytes().ljust(12, b"\0") for y in (1, 0))
    head = b"BM" + (54 + len(rows)).to_bytes(4, "little") + bytes(4) + (54).to_bytes(4, "little")
    info = (40).to_bytes(4, "little") + (3).to_bytes(4, "little") + (2).to_bytes(4, "little") + (1).to_bytes(2, "little") + (24).to_bytes(2, "little") + bytes(24)
    assert (media.decode(head + info + rows) == rgb).all()
    assert (media.decode(b"P5 1 1 65535 \xff\xff") == 255).all()
    with pytest.raises(ValueError):
        media.decode(b"GIF89a")
    info8 = (40).to_bytes(4, "little") + (2).to_bytes(4, "little") + (1).to_bytes(4, "little") + (1).to_bytes(2, "little") + (8).to_bytes(2, "little") + bytes(16) + (2).to_bytes(4, "little") + bytes(4)
    palette = b"\0\0\0\0" + b"\xff\xff\xff\0"
    head8 = lambda at: b"BM" + bytes(8) + at.to_bytes(4, "little")
    assert (media.decode(head8(62) + info8 + palette + bytes([1, 0, 0, 0])) == [[255, 0]]).all()
    broken = [head8(62) + info8 + palette + bytes([9, 0, 0, 0]), head8(62)[:10] + b"\xff" * 4 + info8, b"P2 1 1 255 99999999999999999999999", b"P2 1 1 255 x", b"P2 1 1 255 -3", b"P2 1 1 9 12", b"P1 2 1 1 7"]
    broken += [b"P5 " + b"9" * 30 + b" 1 255 x", b"P6 99999999 99999999 255 x", b"P3", b"P4 8 1", b"BM", b"BM" + bytes(60), b"P5 1 1 0 x", head8(62) + info8[:4] + (2**31 - 1).to_bytes(4, "little") * 2 + info8[12:] + palette]
    for bad in broken:
        with pytest.raises(ValueError):
            media.decode(bad)


def test_tiles_are_written_as_npy(spark):
    import io

    rows = media.text_media(spark.createDataFrame([(1, "some text " * 99), (2, None)], "doc_id long, text string"), tiles=True).collect()
    for r in rows:
        assert r["feature"].endswith(f"npy:{zlib.crc32(bytes(r['npy'])):08x}") and np.load(io.BytesIO(bytes(r["npy"]))).shape == (64, 64)


@pytest.mark.parametrize("seed", range(3))
def test_no_bytes_break_the_decoder(spark, seed):
    rng = np.random.default_rng(seed)
    starts = [b"P1", b"P2", b"P3", b"P4", b"P5", b"P6", b"BM", b"P2 3 2 255 ", b"P5 2 2 255\n", b"BM" + bytes(8) + b"\x36\0\0\0" + b"\x28\0\0\0\x02\0\0\0\x02\0\0\0\x01\0\x08\0"]
    images = [(i, bytearray(starts[i % len(starts)] + bytes(rng.integers(0, 256 if i % 2 else 60, int(rng.integers(0, 200)), np.uint8)))) for i in range(600)]
    got = media.media_columns(spark.createDataFrame(images, "k long, img binary"), "k", "img").collect()
    assert len(got) == 600 and all((r["error"] is None) == (r["npy"] is not None) for r in got)


def test_area_resize_keeps_the_mean_and_blocks():
    x = np.random.default_rng(0).integers(0, 256, (48, 64))
    assert np.allclose(media.resize_area(x, 12, 16), x.reshape(12, 4, 16, 4).mean(axis=(1, 3)))
    assert media.resize_area(x, 7, 5).mean() == pytest.approx(x.mean())
    assert np.allclose(media.resize_area(np.array([[5]]), 8, 9), 5.0)


def test_media_columns_report_bad_images(spark):
    df = spark.createDataFrame([(1, bytearray(media.store_text("abc"))), (2, bytearray(b"nope")), (3, None)], "k long, img binary")
    got = {r["key"]: r for r in media.media_columns(df, "k", "img").collect()}
    assert got[1]["width"] == 64 and np.load(__import__("io").BytesIO(got[1]["npy"])).shape == (64, 64)
    assert got[2]["error"] and got[3]["error"]


def test_empty_tables(spark):
    e = cases.empty(spark)
    for out in (sharding.shard_by_splitters(e), simhash.simhash_components(e), mixing.mix_sources(e), pii.personal_data(e), media.text_media(e), simhash.stage_dedup(spark, e, ""), mixing.stage_mix(spark, e, ""), pii.stage_pii(spark, e, "")):
        assert out.count() == 0
    assert urlfilter.filter_urls(spark.createDataFrame([], "page_id long, url string")).count() == 0
