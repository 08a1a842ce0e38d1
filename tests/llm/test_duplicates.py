"""Components, SimHash, tiling, license scans, line deduplication, archives and the pipeline."""

import gzip
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import brute
from tests.llm.conftest import ODD
from twosided.llm import license_scan, line_dedup, simhash, tiling, warc
from twosided.llm.components import connected_components
from twosided.llm.queries import QUERIES
from twosided.session import new_path

SF_DIR = "/root/testdata/sf0.001"


def test_components_of_random_links(spark):
    rng = random.Random(1)
    links = [(rng.randint(0, 400), rng.randint(0, 400)) for _ in range(260)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5, 5)]
    sets = brute.Sets({x for link in links for x in link})
    for a, b in links:
        sets.join(a, b)
    rows = connected_components(spark.createDataFrame([*links, (None, 3), links[0]], "a long, b long")).collect()
    assert {r.node: r.component for r in rows} == {x: sets.root(x) for a, b in links for x in (a, b) if a != b}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("hot_key", [simhash.HOT_KEY, 3])
def test_all_near_fingerprints_are_linked(spark, hot_key):
    rng = random.Random(2)
    codes = {rng.getrandbits(64) for _ in range(300)} | {0, 2**64 - 1}
    for code in list(codes)[:200]:
        for _ in range(rng.randint(1, 4)):
            codes.add(code ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4))))
    signed = [x - (x >> 63 << 64) for x in codes]
    sets = brute.Sets(signed)
    for n, a in enumerate(signed):
        for b in signed[n + 1 :]:
            if ((a ^ b) % 2**64).bit_count() <= 2:
                sets.join(a, b)
    found = brute.Sets(signed)
    for r in simhash.links(spark.createDataFrame([(x,) for x in signed], "f long"), "f", 2, hot_key).collect():
        found.join(r.a, r.b)
    assert {x: found.root(x) for x in signed} == {x: sets.root(x) for x in signed}


def test_gray_ranks():
    codes = np.arange(256, dtype=np.uint64)
    order = codes[np.argsort(simhash.gray_rank(codes))]
    assert (np.bitwise_count(order[1:] ^ order[:-1]) == 1).all()


def test_simhash_components(spark, small):
    rows = QUERIES["op4_simhash"](spark, SF_DIR).collect()
    assert {r.doc_id: r.component_id for r in rows} == brute.simhash_components(small[1])
    assert {r.doc_id: r.fingerprint for r in rows} == {i: f"{brute.simhash(x):016x}" for i, x in small[1].items()}


def test_simhash_of_odd_rows(spark, odd, none):
    rows = simhash.near_duplicates(odd, "doc_id", "text").collect()
    assert len(rows) == len(ODD)
    assert {r.component for r in rows if r.fingerprint == 0} == {1}
    kept = simhash.keep_first(odd, "doc_id", "text")
    assert kept.columns == odd.columns
    left = kept.select("doc_id", "text").collect()
    assert sorted(str(r.doc_id) for r in left) == ["1", "4", "4", "5", "6", "7", "8"]
    assert simhash.keep_first(none, "doc_id", "text").count() == 0


def test_tiles_are_those_of_all_matches():
    rng = random.Random(3)
    for _ in range(1500):
        letters = [b"a", b"b", b"c", b"d"][: rng.randint(1, 4)]
        a, b = ([rng.choice(letters) for _ in range(rng.randint(0, n))] for n in (40, 25))
        if rng.random() < 0.6 and len(b) > 6:
            cut = rng.randint(1, len(b) - 1)
            a += b[cut:] + b[:cut]
        least = rng.choice([2, 3, 5])
        assert tiling.tile(a, b, least) == brute.tiles(a, b, least)


def test_contaminated_documents(spark, small):
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()}
    rows = QUERIES["op8_decontamination"](spark, SF_DIR).collect()
    wanted = {(i, j, round(c, 9)) for i, text in small[1].items() for j, item in items.items() if (c := brute.covered(text, item)) >= 0.8}
    assert {(r.doc_id, r.item_id, round(r.coverage, 9)) for r in rows} == wanted and wanted


def test_reordered_and_odd_passages(spark, odd, none):
    rng = random.Random(5)
    item = [f"w{i}" for i in range(40)]
    blocks = [item[i : i + 8] for i in range(0, 40, 8)]
    rng.shuffle(blocks)
    rows = [(1, "x " * 9000 + " y ".join(" ".join(b).upper() for b in blocks)), (2, " ".join(item[:28])), (3, " ".join(item[:33])),
            (4, " ".join(reversed(item))), (None, " ".join(item)), (5, " ".join(item)), (5, " ".join(item)), (6, None), (7, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").unionByName(odd.select(F.col("doc_id") + 100, "text").toDF("doc_id", "text"))
    bench = spark.createDataFrame([(1, " ".join(item)), (2, None), (3, ""), (4, "too short"), (1, " ".join(item)), (None, "w0 w1 w2 w3 w4 w5")],
                                  "item_id long, text string")
    found = {(r.id, r.item): round(r.coverage, 3) for r in tiling.coverage(docs, bench, "doc_id", "text", "item_id", "text").collect()}
    assert {k: v for k, v in found.items() if k[1] == 1} == {(1, 1): 1.0, (2, 1): 0.7, (3, 1): 0.825, (None, 1): 1.0, (5, 1): 1.0}
    clean = tiling.decontaminate(docs, bench.filter("item_id = 1")).collect()
    assert sorted(str(r.doc_id) for r in clean if r.doc_id is None or r.doc_id < 100) == ["2", "4", "6", "7", "None", "None"]
    assert len(clean) == 4 + len(ODD)
    assert tiling.decontaminate(none, bench).count() == 0
    kept = tiling.decontaminate(odd, bench.limit(0))
    assert kept.columns == odd.columns and kept.count() == len(ODD)


def test_license_scan_of_odd_rows(spark, odd, none):
    mit, apache = license_scan.TEMPLATES["MIT-text"], license_scan.TEMPLATES["Apache-2.0"]
    text = "Title of a document that goes on and on\n" + apache.upper().replace(" ", "   ") + "\nlicensed\n"
    docs = spark.createDataFrame([(1, text), (1, text), (None, mit.replace(". ", ".\n").replace(", ", "\n")), (2, "MIT"), (3, None),
                                  (4, "Licensed under the Apache License, Version 2.0 or a later version of the licence as you wish")], "doc_id long, text string")
    rows = [tuple(r) for r in license_scan.scan(docs, "doc_id", "text").collect()]
    assert sorted(rows, key=str) == [(1, 1, "Apache-2.0", 1.0), (None, -1, "MIT-text", 1.0)]
    assert license_scan.scan(odd, "doc_id", "text").count() == 0 and license_scan.scan(none, "doc_id", "text").count() == 0


def test_size_bounds_lose_nothing(spark):
    words = license_scan.TEMPLATES["Apache-2.0-notice"].split()
    rng, texts = random.Random(6), []
    for i in range(300):
        own = [w for w in words if rng.random() > 0.1 * (i % 4)] + ["more"] * 0 + [f"x{j}" for j in range(rng.randint(0, 14))]
        texts.append((i, " ".join(own)))

    def pairs(text):
        w = "".join(c if c.isalnum() else " " for c in text.lower()).split()
        return set(zip(w, w[1:], strict=False))

    wanted = set()
    for i, text in texts:
        for name, template in license_scan.TEMPLATES.items():
            x, y = pairs(text), pairs(template)
            if 2 * len(x & y) >= 0.8 * (len(x) + len(y)):
                wanted.add((i, name))
    found = license_scan.scan(spark.createDataFrame(texts, "doc_id long, text string"), "doc_id", "text")
    assert {(r.id, r.license) for r in found.collect()} == wanted and len(wanted) > 50


def near_lines(n: int) -> list[tuple[int, str]]:
    """Documents whose lines repeat with edits, and many lines that share a passage without being alike."""
    rng = random.Random(7)
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 9)))
    passage = " ".join(word() for _ in range(14))
    rows = []
    for i in range(n):
        line = [word() for _ in range(30)]
        lines = [" ".join(line), passage + " " + " ".join(word() for _ in range(16))]
        for _ in range(3):
            edited = list(line)
            edited[rng.randrange(30)] = word()
            lines.append(" ".join(edited))
        rows.append((i, "\n".join(lines)))
    return rows


def test_lines_that_repeat_are_removed(spark):
    rows = near_lines(60)
    found = {r.id: r.removed for r in line_dedup.report(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text").collect()}
    assert found == brute.removed_lines(dict(rows))


def test_crowded_keys_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "SMALL_KEY", 3)
    monkeypatch.setattr(line_dedup, "HOT_LINES", 20)
    rows = near_lines(40)
    found = {r.id: r.removed for r in line_dedup.report(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text").collect()}
    assert found == brute.removed_lines(dict(rows))


def test_lines_mostly_of_one_passage_lose_no_link(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 9)))
    passage, rows = " ".join(word() for _ in range(60)), []
    for i in range(120):
        own = [word() for _ in range(11)]
        rows += [(i, f"{passage} {' '.join(own)}"), (1000 + i, f"{passage} {' '.join(own[:-1])} {word()}")]
    wanted = brute.removed_lines(dict(rows))
    assert 120 <= sum(map(len, wanted.values())) < 125
    found = {r.id: r.removed for r in line_dedup.report(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text").collect()}
    assert found == wanted


def test_lines_alike_by_frequent_shingles_alone_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "RARE_LINES", 0)  # every shingle that two lines share is a frequent one
    rng, rows = random.Random(12), []
    for _ in range(60):
        words = rng.choices(["amber", "birch", "cedar", "delta", "ember", "flint", "grove", "heath", "inlet", "jetty"], k=24)
        for _ in range(3):
            other = list(words)
            other[rng.randrange(24)] = rng.choice(["knoll", "ledge", "marsh"])
            rows.append((len(rows), " ".join(other)))
    texts = {text for _, text in rows}
    lines = line_dedup._Lines(line_dedup._lines(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text"))
    h = F.struct("h1", "h2")
    text_of = {tuple(r.h): r.line for r in lines.table.select(h.alias("h"), "line").collect()}
    ranked = lines.ranked(lines.table.select(h.alias("h"), h.alias("c")))

    def components(links):
        sets = brute.Sets(texts)
        for a, b in links:
            sets.join(a, b)
        return {x: sets.root(x) for x in texts}

    def named(links):
        return [(text_of[tuple(r.a)], text_of[tuple(r.b)]) for r in links.collect()]

    first = lines.verified(lines.sharing(ranked))
    rest = lines.verified(lines.remaining(ranked, line_dedup._components(first)))
    wanted = components(brute.line_links(list(texts)))
    assert components(named(first)) != wanted
    assert components(named(first) + named(rest)) == wanted


def test_lines_of_few_words_are_not_paired_with_each_other(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "RARE_LINES", 0)
    words = ["amber", "birch", "cedar", "delta", "ember", "flint", "grove", "heath", "inlet", "jetty", "knoll", "ledge", "marsh", "nook"]
    rng = random.Random(13)
    rows = [(i, " ".join(rng.choices(words, k=16))) for i in range(150)]
    rows += [(1000 + i, f"{rows[i][1]} opal") for i in range(20)]
    lines = line_dedup._Lines(line_dedup._lines(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text"))
    h = F.struct("h1", "h2")
    ranked = lines.ranked(lines.table.select(h.alias("h"), h.alias("c")))
    pairs = lines.sharing(ranked).union(lines.remaining(ranked, line_dedup._components(ranked.select(F.col("h").alias("a"), F.col("h").alias("b"))))).distinct()
    wanted = len(brute.line_links([text for _, text in rows]))
    assert 20 <= wanted == lines.verified(pairs).count() and pairs.count() < 2 * wanted
    lines.drop()


def test_parities_never_part_lines_alike(spark):
    rng, rows = random.Random(14), []
    for n in (3, 20, 200, 3000):
        for edits in range(60):
            line = "".join(rng.choices("abcdefgh ", k=n))
            other = list(line)
            for _ in range(edits * n // 600):
                other[rng.randrange(n)] = rng.choice("xyz")
            rows.append((line, "".join(other)))
    df = spark.createDataFrame(rows, "x string, y string")
    for a, n, bits in (("x", "n", "bits"), ("y", "n2", "bits2")):
        df = df.withColumn("all", line_dedup._shingles(F.col(a))).withColumns({n: F.size("all"), bits: line_dedup._parities("all")})
    told = df.select((line_dedup.jaccard(F.col("x"), F.col("y")) >= line_dedup.MIN_JACCARD).alias("like"), line_dedup._may_be_like("n", "bits", "n2", "bits2").alias("may")).collect()
    assert all(r.may for r in told if r.like) and sum(r.like for r in told) > 60 and sum(not r.may for r in told) > 30


def test_tables_of_lines_are_removed(spark):
    line_dedup.report(spark.createDataFrame(near_lines(3), "doc_id long, text string"), "doc_id", "text").collect()
    before = set(spark.sql("SHOW DATABASES").toPandas().iloc[:, 0])
    line_dedup.report(spark.createDataFrame(near_lines(3), "doc_id long, text string"), "doc_id", "text").collect()
    assert set(spark.sql("SHOW DATABASES").toPandas().iloc[:, 0]) == before


def test_lines_without_spaces_are_signed_by_content(spark):
    rng, rows = random.Random(10), []
    for letters in ("".join(map(chr, range(0x4E00, 0x5200))), "abcdefghijklmnopqrstuvwxyz0123456789/", "абвгд\t\u00a0"):
        for _ in range(30):
            line = "".join(rng.choices(letters, k=200))
            at = rng.randrange(70)
            rows += [(line, f"x{line}"), (line, f"{line[:at]}x{line[at:]}"), (line, line[:at] + line[at + 1 :])]
    signed = lambda name: F.array_distinct(F.regexp_extract_all(name, F.lit(line_dedup._SIGNED), F.lit(1)))
    df = spark.createDataFrame(rows, "a string, b string").select(signed("a").alias("x"), signed("b").alias("y"))
    for row in df.collect():
        x, y = set(row.x), set(row.y)
        assert len(x) > 100 and len(x & y) >= 0.8 * len(x | y)


def test_words_are_signed_at_their_starts(spark):
    text = "  one two  thirteenchars x"
    df = spark.createDataFrame([(text,)], "a string").select(F.regexp_extract_all("a", F.lit(line_dedup._SIGNED), F.lit(1)).alias("x"))
    assert df.first().x == ["one two  thi", "two  thirtee", "thirteenchar", "x"]


def test_line_dedup_of_documents(spark, small):
    found = {r.doc_id: r.removed for r in QUERIES["op10_line_dedup"](spark, SF_DIR).collect()}
    wanted = brute.removed_lines(small[1])
    lines = sum(map(len, wanted.values()))
    missed = sum(len(set(wanted[i]) ^ set(found[i])) for i in wanted)
    assert lines > 50 and missed <= 0.03 * lines


def test_line_dedup_of_odd_rows(spark, odd, none):
    kept = line_dedup.deduplicate(odd, "doc_id", "text")
    assert kept.columns == odd.columns
    rows = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    # The text without an id repeats that of 8 and goes with all its lines; equal rows keep the same lines.
    assert rows == sorted((x for x in ODD if x != (None, "a text without an id is here")), key=str)
    assert line_dedup.deduplicate(none, "doc_id", "text").count() == 0


def test_archives_are_read_with_filters(spark):
    pages = spark.createDataFrame([(1, "http://a/", "same"), (2, "http://b/\r\nX: y", "same"), (3, None, None), (4, "http://d/", ""), (5, "http://e/", "é" * 70000),
                                   (None, "http://f/", "same"), (6, "http://g/", "other"), (6, "http://g/", "other")], "page_id long, url string, html string")
    path = new_path(spark, "warc")
    warc.write_pages(pages, path)
    records = warc.read(spark, path)
    assert records.count() == 8
    assert sorted(r.record_id for r in records.filter("record_type = 'revisit'").collect()) == ["<urn:x-page:1>", "<urn:x-page:3>", "<urn:x-page:>"]
    plan = records.filter("record_type = 'response' and target_uri like 'http://e%'")
    assert [len(r.payload) for r in plan.collect()] == [140000]
    assert warc.read(spark, path, payload=False).filter("payload is not null").count() == 0
    found = sorted((tuple(r) for r in warc.round_trip(pages).select("page_id", "payload_bytes", "record_type", "refers_to").collect()), key=str)
    assert found == sorted([(1, 4, "revisit", 2), (2, 4, "response", None), (3, 0, "revisit", 4), (4, 0, "response", None), (5, 140000, "response", None),
                            (None, 4, "revisit", 2), (6, 5, "response", None), (6, 5, "response", None)], key=str)
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_other_archives(spark, tmp_path):
    records = [{"record_type": "response", "record_id": f"<urn:{i}>", "payload": bytes([i]) * 30000 * i} for i in range(4)]
    for i, record in enumerate(records):
        raw = warc._record(dict.fromkeys(warc.HEADERS) | record)
        (tmp_path / f"{i}.warc.gz").write_bytes(gzip.compress(raw) * 2)
        (tmp_path / f"{i}.warc").write_bytes(raw * 2)
    for payload in (True, False):
        rows = warc.read(spark, str(tmp_path), payload).filter("record_id in ('<urn:1>', '<urn:3>')").collect()
        assert sorted((r.record_id, len(r.payload or b"")) for r in rows) == [
            (f"<urn:{i}>", 30000 * i * payload) for i in (1, 3) for _ in range(4)]


def test_stages_against_plain_versions(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    now = {r.doc_id: r.text for r in docs.collect()}
    frame = docs
    items = [r.text for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES:
        path = new_path(spark, "stage")
        stage(spark, frame, SF_DIR).write.parquet(path)
        frame = spark.read.parquet(path)
        got = {r.doc_id: r.text for r in frame.collect()}
        if name == "toxicity":
            scores = {r.doc_id: r.score for r in QUERIES["op5_toxicity"](spark, SF_DIR).collect()}
            wanted = {i: x for i, x in now.items() if scores[i] < 0.5}
        elif name == "line dedup":
            gone = brute.removed_lines(now)
            wanted = {i: "\n".join(x for n, x in enumerate(text.split("\n")) if n not in gone[i]) for i, text in now.items()}
            wanted = {i: x for i, x in wanted.items() if x.replace("\n", "").strip(" ") or not now[i].strip(" \n")}
        elif name == "SimHash near-dedup":
            root = brute.simhash_components(now)
            wanted = {i: x for i, x in now.items() if root[i] == i}
        elif name == "benchmark decontamination":
            wanted = {i: x for i, x in now.items() if all(brute.covered(x, item) < 0.8 for item in items)}
        else:
            wanted = now
            assert {"n_tokens", "ids_sha256", "decoded_sha256"} <= set(frame.columns)
        same = sum(got.get(i) == wanted.get(i) for i in got.keys() | wanted.keys())
        assert same >= (0.99 if name == "line dedup" else 1) * len(got.keys() | wanted.keys()), name
        assert set(docs.columns) <= set(frame.columns)
        now = got


def test_empty_and_odd_documents_pass_the_pipeline(spark, odd, none):
    for docs, least in ((none, 0), (odd.withColumn("n_chars", F.lit(0).cast("long")), 5)):
        for _, stage in corpus_pipeline.STAGES:
            path = new_path(spark, "stage")
            stage(spark, docs, SF_DIR).write.parquet(path)
            docs = spark.read.parquet(path)
        assert docs.count() >= least


def test_digests_are_of_whole_texts(spark, small):
    rows = QUERIES["op3_bpe"](spark, SF_DIR).collect()
    empty = hashlib.sha256(b"").hexdigest()
    assert {r.doc_id for r in rows} == set(small[1]) and all((r.ids_sha256 == empty) == (r.n_tokens == 0) for r in rows)
