"""Quality, sharding, media, personal data, near duplicates and language model against plain Python."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from eqspark.llm import hilbert, kneser_ney, minhash_join, mpegts, pii, quality_forest
from pyspark.sql import functions as F

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def base_statistics(text):
    words = WORDS.findall(text or "")
    grams = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {j for i in range(len(words) - 4) if grams[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORDS.search(line):
            dup += line in seen
            seen.add(line)
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered), failed


def test_quality(odd, docs, labels):
    model = quality_forest.fit(docs, labels)
    for table in (odd, docs):
        rows = quality_forest.assess(table, model).collect()
        assert Counter(tuple(r)[:7] for r in rows) == Counter((i, *base_statistics(t)) for i, t in table.select("doc_id", "text").collect())
        assert not any(r.kept and r.base_failed for r in rows)
        kept = quality_forest.keep_good(table, model)
        assert kept.columns == table.columns and Counter(kept.select("doc_id").collect()) == Counter((r.doc_id,) for r in rows if r.kept)
    quality = dict(map(tuple, labels.select("doc_id", "quality").collect()))
    good = [r.kept for r in rows if quality.get(r.doc_id) == 1]
    assert sum(good) >= 0.95 * len(good)


def test_labelled_bad_documents_go(spark, docs, labels):
    words = [f"w{i} is" for i in range(2000)]
    junk = [(-1 - i, " ".join(f"{w}%%%" for w in words[9 * i : 9 * i + 30]), 0) for i in range(40)]
    good = [(-101 - i, " ".join(words[9 * i : 9 * i + 30]), 1) for i in range(200)]
    made = spark.createDataFrame(junk + good, "doc_id long, text string, quality int")
    for table, quality in ((docs, labels), (made, made)):
        rows = quality_forest.assess(table, quality_forest.fit(table, quality)).where("not base_failed")
        n = {k: [r.kept for r in rows.join(quality.where(f"quality = {k}"), "doc_id").collect()] for k in (0, 1)}
        assert n[0] and sum(n[0]) <= 0.05 * len(n[0]) and sum(n[1]) >= 0.998 * len(n[1])


def test_forest_finds_outliers_and_needs_labels(odd, labels):
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(size=(500, 3)), rng.normal(8, 1, size=(5, 3))])
    score = quality_forest.IsolationForest().fit(x).score(x)
    assert score[500:].min() > np.quantile(score[:500], 0.97)
    assert quality_forest.fit(odd, labels.limit(0)).threshold == math.inf
    assert quality_forest.repeated_words([str(i % 7000).encode() for i in range(7300)], 5) == 600


def walked(forest, features):
    """A row's score by walking each tree from its root."""
    total = 0.0
    for t in range(forest.trees):
        node = depth = 0
        while forest.feature[t, node] >= 0:
            node, depth = 2 * node + (1 if features[forest.feature[t, node]] < forest.split[t, node] else 2), depth + 1
        assert depth <= forest.path[t, node] and depth <= 5
        total += forest.path[t, node]
    return 2 ** (-total / forest.trees / forest.norm)


def test_forest_paths_against_a_walk(docs, labels):
    x = np.round(np.random.default_rng(2).normal(size=(300, 4)), 1)
    forest = quality_forest.IsolationForest(trees=30, subsample=32).fit(x)
    for n in (10, 32, 256, 4096):  # the harmonic sum, which the logarithm stands for
        assert quality_forest.expected_path(n) == pytest.approx(2 * sum(1 / k for k in range(1, n)) - 2 * (n - 1) / n, rel=0.05)
    assert forest.norm == pytest.approx(float(quality_forest.expected_path(32)))
    assert forest.score(x[:60]) == pytest.approx([walked(forest, row) for row in x[:60]])
    model = quality_forest.fit(docs, labels)
    own, narrow, threshold = model.telling
    texts = dict(map(tuple, docs.select("doc_id", "text").collect()))
    for r in quality_forest.assess(docs, model).collect():
        features = quality_forest.statistics(texts[r.doc_id])[1]
        good = walked(model.forest, features) < model.threshold and walked(narrow, [features[k] for k in own]) < threshold
        assert r.kept == (good and not base_statistics(texts[r.doc_id])[-1])


def test_very_long_texts(spark):
    """Several megabytes in one text, beside a near copy and a short one."""
    r = random.Random(6)
    words = [f"{r.choice('abcdefgh')}{r.randrange(400)}{r.choice(['', ',', ' #', chr(10), ' é'])}" for _ in range(500_000)]
    long, near = " ".join(words), " ".join(words[:250_000] + ["other"] + words[250_001:])
    run = "x" * 2_000_000
    table = spark.createDataFrame([(1, long), (2, near), (3, run), (4, "short")], "doc_id long, text string").repartition(2)
    texts = {1: long, 2: near, 3: run, 4: "short"}
    assert len(long) > 2_500_000
    got = {r.doc_id: r for r in mpegts.read_streams(mpegts.store_streams(table)).collect()}
    for i, t in texts.items():
        data = t.encode() + b"\xff" * (-len(t.encode()) % 576)
        assert got[i].payload_sha256 == hashlib.sha256(data).hexdigest() and not got[i].damaged
    classes = {r.doc_id: (r.class_id, r.n_links) for r in minhash_join.join_documents(table).collect()}
    assert classes == {1: (1, 1), 2: (1, 1), 3: (3, 0), 4: (4, 0)}
    stats = {r.doc_id: r for r in quality_forest.assess(table, quality_forest.QualityModel(None, math.inf)).collect()}
    for i in (1, 3, 4):
        assert tuple(stats[i])[1:7] == base_statistics(texts[i])
    scored = {r.doc_id: r.n_tokens for r in kneser_ney.score_documents(table).collect()}
    assert scored == {i: len(t.split()) + 1 for i, t in texts.items()}
    sized = {r.doc_id: r.size for r in hilbert.shard_documents(table.withColumns({"lang": F.lit("en"), "source": F.lit("s")})).collect()}
    assert sized == {i: len(t.encode()) + 16 for i, t in texts.items()}
    spans = {r.doc_id: r.spans for r in pii.report(table).collect()}
    assert spans[3] == ""  # plain Python would take hours
    assert all(spans[i] == ",".join(f"{k}:{a}:{b}" for k in pii.BASE for a, b in base_spans(texts[i])[k]) for i in (1, 2, 4))


@pytest.mark.parametrize(("dimensions", "bits"), [(3, 3), (2, 5), (4, 2), (1, 4), (3, 1)])
def test_hilbert_curve_is_continuous(spark, dimensions, bits):
    cells = list(itertools.product(range(1 << bits), repeat=dimensions))
    names = [f"d{i}" for i in range(dimensions)]
    rows = spark.createDataFrame(cells, ", ".join(f"{n} int" for n in names))
    found = {tuple(r[:-1]): r[-1] for r in rows.select(*names, hilbert.curve_index([F.col(n) for n in names], bits)).collect()}
    assert sorted(found.values()) == list(range(1 << dimensions * bits))
    path = np.array(sorted(cells, key=found.__getitem__))
    assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def test_names_have_cells_in_their_order(spark):
    names = [None, "", "a", "é", "z", *(f"n{i:04d}" for i in range(300))]
    rows = spark.createDataFrame([(n, "x" if n else None) for n in names * 2], "a string, b string")
    for bits in (2, 6, 9):
        a, b = hilbert.name_bounds(rows, ["a", "b"], bits)
        assert len(a) == min(2**bits - 1, 304) and b == ["x"]
        cells = {r[0]: r[1:] for r in rows.select("a", hilbert.name_cell(F.col("a"), a), hilbert.name_cell(F.col("b"), b)).collect()}
        order = [cells[n][0] for n in sorted(names, key=lambda n: (n is not None, (n or "").encode()))]
        assert order == sorted(order) and order[0] == 0 and set(order) == set(range(len(a) + 1)) and {c[1] for n, c in cells.items() if n} == {1}
        per_cell = Counter(order[1:]).values()
        assert max(per_cell) - min(per_cell) <= 1


@pytest.mark.parametrize("shards", [1, 7, 40, 400])
def test_shards(odd, docs, shards):
    for table in (odd, docs):
        rows = hilbert.shard_documents(table, shards).collect()
        want = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in table.select("doc_id", "text").collect())
        assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == want
        by = defaultdict(list)
        for r in rows:
            by[r.shard].append(r)
        sizes = [len(by[s]) for s in range(shards)]
        assert max(sizes) - min(sizes) <= 1 and set(by) <= set(range(shards))
        for s in by:
            assert sorted(r.slot for r in by[s]) == list(range(len(by[s])))
        cells = [r.cell for r in sorted(rows, key=lambda r: (r.shard, r.slot))]
        assert cells == sorted(cells)


def test_written_shards_are_whole_with_null_and_repeated_ids(spark, odd, tmp_path):
    ranges = hilbert.write_shards(odd, str(tmp_path / "shards"), 7).collect()
    back = spark.read.parquet(str(tmp_path / "shards"))
    clash = odd.withColumns({"shard": F.lit("own"), "slot": F.lit(7), "cell": F.lit(1.5)})
    assert hilbert.write_shards(clash, str(tmp_path / "clash"), 3).agg(F.sum("rows")).first()[0] == odd.count()
    second = spark.read.parquet(str(tmp_path / "clash"))
    assert Counter(second.select(*clash.columns).collect()) == Counter(clash.collect()) and {r.shard_ for r in second.collect()} == {0, 1, 2}
    assert Counter(back.select(*odd.columns).collect()) == Counter(odd.collect())
    assert {r.shard: r.rows for r in ranges} == Counter(r.shard for r in back.collect())


def test_streams(odd, docs):
    for table in (odd, docs):
        texts = defaultdict(list)
        for i, t in table.select("doc_id", "text").collect():
            texts[i].append(t or "")
        rows = mpegts.read_streams(mpegts.store_streams(table)).collect()
        assert len(rows) == sum(map(len, texts.values()))
        feature = {}
        for r in rows:
            found = [d for d in map(str.encode, texts[r.doc_id]) if len(d) == r.n_bytes]
            assert found
            data = found[0] + b"\xff" * (-len(found[0]) % 576 or (576 if not found[0] else 0))
            stream = mpegts.mux(data)
            assert (r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(data), hashlib.sha256(data).hexdigest(), zlib.crc32(data[-32:]))
            assert (r.media_bytes, r.media_sha256) == (len(stream), hashlib.sha256(stream).hexdigest())
            assert feature.setdefault(found[0], r.feature) == r.feature


def test_stream_faults():
    stream = mpegts.mux(bytes(range(256)) * 9 * 30)
    got = mpegts.demux(stream)
    assert got["pts"].tolist() == [3600 * i for i in range(120)] and got["access"].tolist() == [0, 25, 50, 75, 100]
    assert got["clock"].tolist() == [(3600 * i - mpegts.DELAY) % 2**33 for i in range(120)] and got["sizes"].tolist() == [576] * 120
    assert got["continuity_errors"] == 0 and not len(got["damaged"])
    packets = [stream[i : i + 188] for i in range(0, len(stream), 188)]
    lost = mpegts.demux(b"".join(packets[:9] + packets[10:]))
    assert lost["continuity_errors"] == 1 and lost["damaged"].tolist() == [1]  # packets 6 to 9 are unit 1
    assert mpegts.demux(b"".join(packets[:102] + packets[103:]))["continuity_errors"] == 1  # a table is lost
    assert mpegts.demux(b"".join(packets[:9] + packets[8:]))["payload"] == got["payload"]
    for broken in (b"x" + stream[1:], stream[:100], stream[:20] + b"\0" + stream[21:], b"", stream[188:376], stream[:376]):
        with pytest.raises(ValueError):
            mpegts.demux(broken)
    for k, at in enumerate(mpegts.access_offsets(120)):
        joined = mpegts.demux(stream[at:])
        assert joined["payload"] == got["payload"][25 * 576 * k :] and joined["pts"][0] == 90_000 * k and joined["continuity_errors"] == 0
    with pytest.raises(ValueError):  # no tables before the units, until the next access point's
        mpegts.demux(b"".join(packets[5:102]))


def test_a_stream_built_by_hand():
    """Written byte by byte from the format: other PIDs, a null packet, two units of other lengths, one without a clock."""
    def crc(data):
        r = 0xFFFFFFFF
        for bit in "".join(f"{b:08b}" for b in data):
            r = (r << 1 ^ (0x04C11DB7 if (r >> 31) ^ int(bit) else 0)) & 0xFFFFFFFF
        return r.to_bytes(4, "big")

    def section(body):
        return body + crc(body)

    pat = section(bytes.fromhex("00b00d0007c10000" + "0003e234"))  # program 3 on PID 0x234
    pmt = section(bytes.fromhex("02b0120003c10000" + "e345f000" + "06e345f000"))  # data and clock on PID 0x345
    packet = lambda pid, first, counter, data: bytes([0x47, first << 6 | pid >> 8, pid & 255, 0x10 | counter]) + data.ljust(184, b"\xff")

    def adapted(pid, first, counter, data, flags=b"\0"):
        field = flags + b"\xff" * (183 - len(data) - len(flags))
        return bytes([0x47, first << 6 | pid >> 8, pid & 255, 0x30 | counter, len(field)]) + field + data

    def unit(pts, data):
        time = bytes([0x21 | pts >> 29 & 14, pts >> 22 & 255, pts >> 14 & 254 | 1, pts >> 7 & 255, pts << 1 & 254 | 1])
        return b"\0\0\1\xbd" + (8 + len(data)).to_bytes(2, "big") + b"\x84\x80\5" + time + data

    one, two = unit(8_000_000_000, bytes(range(200))), unit(77, b"last")
    clock = bytes([0x50]) + (5 << 15 | 0x7E00).to_bytes(6, "big")  # random access, clock of 5 ticks
    stream = packet(0, 1, 9, b"\0" + pat) + packet(0x1FFF, 0, 0, b"") + packet(0x234, 1, 3, b"\0" + pmt)
    stream += adapted(0x345, 1, 14, one[:150], clock) + adapted(0x345, 0, 15, one[150:]) + adapted(0x345, 1, 0, two)
    got = mpegts.demux(stream)
    assert got["payload"] == bytes(range(200)) + b"last" and got["pts"].tolist() == [8_000_000_000, 77] and got["sizes"].tolist() == [200, 4]
    assert got["clock"].tolist() == [5, -1] and got["access"].tolist() == [0] and got["continuity_errors"] == 0 and not len(got["damaged"])


def luhn(digits):
    d = [int(c) for c in reversed(digits)]
    return sum(d[0::2] + [sum(divmod(2 * x, 10)) for x in d[1::2]]) % 10 == 0


def base_spans(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    kinds = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(digits(m)) <= 19 and luhn(digits(m))),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(digits(m)) <= 15),
    }
    return {k: [m.span() for m in re.finditer(p, text) if ok(m[0])] for k, (p, ok) in kinds.items()}


def test_personal_data(odd, docs):
    for table in (odd.where("doc_id is not null").dropDuplicates(["doc_id"]), docs):
        texts = dict(map(tuple, table.select("doc_id", "text").collect()))
        rows = pii.report(table).collect()
        assert len(rows) == len(texts)
        for r in rows:
            spans = base_spans(texts[r.doc_id] or "")
            listed = [f"{k}:{a}:{b}" for k in pii.BASE for a, b in spans[k]]
            assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(len(spans[k]) for k in pii.BASE)
            assert r.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest()
            assert r.spans == ",".join(listed + [s for s in r.spans.split(",") if s.startswith(("iban:", "short_card:"))])
    assert pii.report(odd).count() == odd.count()


def test_further_kinds_and_redaction(spark, odd):
    text = dict(map(tuple, odd.where("doc_id is not null").select("doc_id", "text").collect()))[14]
    (row,) = pii.report(odd.where("doc_id = 14")).collect()
    found = [text[int(a) : int(b)] for k, a, b in (s.split(":") for s in row.spans.split(",")) if k in ("iban", "short_card")]
    assert found == ["DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432", "378282246310005"]
    rows = {r.doc_id: r.text for r in pii.redact(odd).where("doc_id is not null").collect()}
    assert rows[14] == "Bank [IBAN], [IBAN] and GB82WEST12345698765431 visa [SHORT_CARD]"
    assert rows[12] == "pay by card [CARD] or 4111-1111-1111-1112, call [PHONE] now +1"
    assert rows[0] is None and rows[1] == "" and rows[6] == rows[7]
    assert pii.redact(odd).columns == odd.columns and pii.redact(odd).count() == odd.count()


def further_spans(text):
    """The two further kinds by plain Python: pattern, checksum, words near."""
    against = "serial|order|part no|model|isbn|sku|invoice|version"
    kinds = {
        "iban": (r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", 70, "iban|bank|account|konto|cuenta|compte",
                 lambda m: int("".join(str(int(c, 36)) for c in (lambda v: v[4:] + v[:4])(m.replace(" ", "")))) % 97 == 1),
        "short_card": (r"(?<![0-9])[0-9]{13,15}(?![0-9])", 40, "card|visa|amex|credit", luhn),
    }
    out = []
    for kind, (pattern, base, words, ok) in kinds.items():
        found = list(re.finditer(pattern, text))
        for k, m in enumerate(found):
            low = found[k - 1].end() if k else 0
            high = found[k + 1].start() if k + 1 < len(found) else len(text)
            near = (text[max(low, m.start() - 40) : m.start()] + " " + text[m.end() : min(high, m.end() + 40)]).lower()
            score = base + 30 * bool(re.search(words, near)) - 30 * bool(re.search(against, near))
            if ok(m[0]) and score >= 60:
                out.append((f"{kind}:{m.start()}:{m.end()}", f"{score / 100:.2f}"))
    return out


def test_further_kinds_against_plain_python(spark):
    r = random.Random(8)

    def iban():
        body = r.choice(["DE", "GB", "FR"]) + "00" + "".join(r.choice("0123456789ABCZ") for _ in range(r.randint(8, 30)))
        rest = 98 - int("".join(str(int(c, 36)) for c in body[4:] + body[:4])) % 97
        made = body[:2] + f"{rest:02d}" + body[4:]
        return " ".join(made[i : i + 4] for i in range(0, len(made), 4)) if r.random() < 0.5 else made

    def card():
        digits = "".join(r.choice("0123456789") for _ in range(r.randint(12, 14)))
        return next(digits + str(k) for k in range(10) if luhn(digits + str(k)))

    wrong = lambda v: v[:-1] + ("7" if v[-1] != "7" else "3")
    words = ["iban", "Bank", "visa", "Credit", "serial", "Order", "no", "and 😀", "x" * 50, "é", "model:"]
    rows = []
    for i in range(500):
        parts = [r.choice([iban, card, lambda: wrong(iban()), lambda: wrong(card()), lambda: r.choice(words), lambda: r.choice(words)])() for _ in range(r.randint(0, 9))]
        rows.append((i, r.choice([" ", ", ", "\n"]).join(parts)))
    got = pii.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    accepted = 0
    for row in got:
        named = list(zip(row.spans.split(","), row.scores.split(","))) if row.spans else []
        assert [n for n in named if n[0].startswith(("iban", "short_card"))] == further_spans(rows[row.doc_id][1])
        assert row.n_spans == len(named) and row.top_score == max([float(s) for _, s in named], default=0.0)
        accepted += len(further_spans(rows[row.doc_id][1]))
    assert accepted > 300


def test_long_runs_of_digits_take_linear_time(spark):
    texts = ["x.@+ " + "1" * 300_000, "1" * 300_000 + ".2.3.4 1.2.3.4", "1.2.3.45.6.7.8 9a1.2.3.4"]
    rows = sorted(pii.report(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect())
    assert [r.n_ip for r in rows] == [0, 1, 2]


def brute_near(rows):
    """Classes and links by comparing all pairs of distinct texts."""
    texts = sorted({t or "" for _, t in rows})
    grams = []
    for t in texts:
        w = t.lower().encode().split()
        grams.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    links, root = Counter(), {t: t for t in texts}

    def find(t):
        while root[t] != t:
            t = root[t]
        return t

    for i, a in enumerate(texts):
        for j in range(i):
            both = len(grams[i] & grams[j])
            if both and 5 * both >= 4 * (len(grams[i]) + len(grams[j]) - both):
                links[a] += 1
                links[texts[j]] += 1
                root[find(a)] = find(texts[j])
    least, copies = {}, Counter(t or "" for _, t in rows)
    for i, t in rows:
        k = find(t or "")
        least[k] = min((x for x in (least.get(k), i) if x is not None), default=None)
    return Counter((i, least[find(t or "")], links[t or ""], copies[t or ""]) for i, t in rows)


def test_near_duplicates(odd, docs, spark):
    big = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    base = " ".join(f"v{i % 97}x{i}" for i in range(150)).split()
    many = [(10_000 + i, " ".join(base[:i] + [f"new{i}"] + base[i + 1 :])) for i in range(150)] + [(20_000 + i, " ".join(base[: i % 140] + [f"n{i}", f"m{i}"] + base[i % 140 + 2 :])) for i in range(300)]
    for table in (odd, docs, big, spark.createDataFrame(many, "doc_id long, text string")):
        rows = [tuple(r) for r in table.select("doc_id", "text").collect()]
        assert Counter(map(tuple, minhash_join.join_documents(table).collect())) == brute_near(rows)
    kept = minhash_join.keep_one(odd)
    classes = {c for _, c, _, _ in brute_near([tuple(r) for r in odd.select("doc_id", "text").collect()])}
    assert kept.columns == odd.columns and sorted(r.doc_id if r.doc_id is not None else -1 for r in kept.collect()) == sorted(c if c is not None else -1 for c in classes)


def test_long_chains_of_near_texts_are_one_class(spark):
    words = [f"w{i}" for i in range(5 * 1200 + 100)]  # neighbours share 91 of 101 n-grams
    chain = [(i, " ".join(words[5 * i : 5 * i + 100])) for i in range(1200)]
    rows = minhash_join.join_documents(spark.createDataFrame(chain, "doc_id long, text string")).collect()
    assert len(rows) == 1200 and {r.class_id for r in rows} == {0}


def test_components_at_any_shape(spark):
    r = random.Random(4)
    shapes = [[(i, i + 1) for i in range(300)], [(i + 1, 0) for i in range(300)], [(i, r.randrange(i)) for i in range(1, 300)], [(0, 0)], [(0, 1), (1, 2), (2, 0), (1, 0)]]
    want, edges = {}, []
    for k, shape in enumerate(shapes):
        names = {i: hashlib.sha256(b"%d %d" % (k, i)).digest()[:16] for i in set(sum(shape, ()))}
        edges += [(bytearray(names[i]), bytearray(names[j])) for i, j in shape]
        want |= dict.fromkeys(names.values(), min(names.values())) if shape != [(0, 0)] else {}
    path = [bytes([i // 256, i % 256]) for i in range(300)]  # in order along the path
    edges += [(bytearray(a), bytearray(b)) for a, b in zip(path, path[1:])]
    want |= dict.fromkeys(path, path[0])
    rows = minhash_join.components(spark.createDataFrame(edges, "node binary, root binary")).collect()
    assert len(rows) == len(want) and {bytes(n): bytes(label) for n, label in rows} == want


def test_banding_meets_the_recall():
    for threshold, recall in ((0.8, 0.99999), (0.8, 0.9), (0.5, 0.99), (0.95, 0.9999), (0.05, 0.99999)):
        bands, rows = minhash_join.choose_banding(threshold, recall)
        assert 1 - (1 - threshold**rows) ** bands >= recall > 1 - (1 - threshold**rows) ** (bands - 1)
        assert bands * rows <= 96 or rows == 1
    assert minhash_join.choose_banding(0.8, 0.99999) == (22, 4)


def test_measured_recall_at_the_threshold():
    rng = np.random.default_rng(3)
    for recall in (0.9, 0.99999):
        bands, rows = minhash_join.choose_banding(0.8, recall)
        met = 0
        for seed in range(1500):
            grams = rng.integers(0, 1 << 63, 180, dtype=np.uint64)  # 160 shared and 20 of each: 160 / 200
            sign = minhash_join.Signer(bands, rows, seed)
            met += bool(set(sign(np.unique(grams))) & set(sign(np.unique(np.concatenate([grams[:160], rng.integers(0, 1 << 63, 20, dtype=np.uint64)])))))
        assert met / 1500 >= recall - 0.02


def brute_kneser_ney(texts, order):
    """log10 probabilities of the tokens of any text, by plain dictionaries."""
    lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    tokens = lambda t: [*WORDS.findall(lower(t)), None]
    grams = lambda w, k: [tuple(([0] * (k - 1) + w)[i : i + k]) for i in range(len(w))]
    raw = Counter(g for t in texts for g in grams(tokens(t), order))
    adjusted = {order: raw}
    for k in range(order - 1, 0, -1):
        adjusted[k] = Counter()
        for g, c in adjusted[k + 1].items():
            adjusted[k][g[1:]] += c if g[1] == 0 else 1
    after = {k: defaultdict(list) for k in adjusted}
    for k, counts in adjusted.items():
        for g, c in counts.items():
            after[k][g[:-1]].append(c)

    def discounts(counts):
        n1, n2, n3, n4 = (sum(c == k for c in counts) for k in (1, 2, 3, 4))
        if not (n1 and n2 and n3):
            return [0, 0.5, 1.0, 1.5]
        y = n1 / (n1 + 2 * n2)
        return [0] + [min(max(k - (k + 1) * y * b / a, 0), k) for k, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]

    d = {k: discounts(adjusted[k].values()) for k in adjusted}
    v, total = len(adjusted[1]), sum(adjusted[1].values())
    rest = sum(d[1][min(c, 3)] for c in adjusted[1].values())
    weight = {k: {h: (sum(c), sum(d[k][min(x, 3)] for x in c)) for h, c in after[k].items()} for k in adjusted}

    def p(g):
        k, c = len(g), adjusted[len(g)][g]
        if k == 1:
            return (max(c - d[1][min(c, 3)], 0) + rest / (v + 1)) / total if total else 1 / (v + 1)
        if g[:-1] not in weight[k]:
            return p(g[1:])
        sum_, left = weight[k][g[:-1]]
        return (max(c - d[k][min(c, 3)], 0) + left * p(g[1:])) / sum_

    return lambda t: [math.log10(p(g)) for g in grams(tokens(t), order)], p, [w for (w,) in adjusted[1]]


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_kneser_ney(odd, docs, order):
    for table in (docs, odd):
        rows = [tuple(r) for r in table.select("doc_id", "text").collect()]
        held = lambda i: zlib.crc32(str(i).encode() if i is not None else b"") % 7 == 2
        tokens = lambda t: [*WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or "")), None]
        training = [t for i, t in rows if not held(i)]
        uni = Counter(w for t in training for w in tokens(t))
        n, v = sum(uni.values()), len(uni)
        scores, p, vocabulary = brute_kneser_ney(training, order)
        want = defaultdict(list)
        for i, t in rows:
            w = tokens(t)
            want[i].append((held(i), len(w), sum(uni[x] > 0 for x in w), n, sum(math.log10((uni[x] + 1) / (n + v + 1)) for x in w), sum(scores(t))))
        got = kneser_ney.score_documents(table, order).collect()
        assert len(got) == len(rows)
        for r in got:
            assert any(tuple(r)[1:5] == x[:4] and r.base_score == pytest.approx(x[4]) and r.score == pytest.approx(x[5]) for x in want[r.doc_id])
    for context in ((0,) * (order - 1), (0, "pay")[: order - 1], ("never", "seen", "before")[: order - 1]):
        if len(context) == order - 1:
            assert sum(p((*context, w)) for w in [*vocabulary, "unknown"]) == pytest.approx(1)


def test_small_buckets_change_nothing(docs, monkeypatch):
    whole = {r.doc_id: r.score for r in kneser_ney.score_documents(docs).collect()}
    for tokens in (20_000, 1500):
        monkeypatch.setattr(kneser_ney, "TOKENS_A_BUCKET", tokens)
        for i, s in ((r.doc_id, r.score) for r in kneser_ney.score_documents(docs).collect()):
            assert s == pytest.approx(whole[i])


def test_empty(empty, labels):
    model = quality_forest.fit(empty, labels)
    assert model.threshold == math.inf and quality_forest.assess(empty, model).collect() == [] == quality_forest.keep_good(empty, model).collect()
    assert hilbert.shard_documents(empty).collect() == [] == mpegts.read_streams(mpegts.store_streams(empty)).collect()
    assert pii.report(empty).collect() == [] == pii.redact(empty).collect()
    assert minhash_join.join_documents(empty).collect() == [] == minhash_join.keep_one(empty).collect()
    assert kneser_ney.score_documents(empty).collect() == []
