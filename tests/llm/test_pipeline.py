"""The pipeline against a plain version of its first three stages and the laws of the last two."""

import random
import re
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from cartograin.llm.catalog import QUERIES
from cartograin.llm.mixing import mix_report
from cartograin.llm.oracle import ORACLE

from .test_decontamination import smith_waterman
from .test_minhash import shingles

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def corpus():
    rng = random.Random(21)
    syllables = ["ka", "lo", "mi", "ne", "tu", "ra", "so", "vi", "po", "du"]

    def words(n):
        return ["".join(rng.choices(syllables, k=rng.randrange(2, 5))) for _ in range(n)]

    menu = "home news contact imprint terms privacy jobs press help search more"
    items = [" ".join(words(30)) for _ in range(3)]
    rows = []
    for i in range(60):
        body = words(rng.randrange(25, 90))
        if i % 11 == 0:
            at = rng.randrange(len(body))
            leak = items[i % 3].split()
            leak[7] = "changed"
            body[at:at] = leak
        text = " ".join(body) + (f"\n{menu}" if i % 3 == 0 else "")
        rows.append((text, f"s{i % 3}"))
        if i % 7 == 0:
            body[3] = "edited"
            rows.append((" ".join(body), "s1"))
        if i % 9 == 0:
            rows.append((text, "s0"))
    rows += [(f"{menu}\nonly {a} {b} here with menu text around it", "s0") for a, b in zip(words(12), words(12))]
    rows += [("too short", "s2"), ("", "s2"), (None, None), ("again and again " * 20, "s1")]
    rng.shuffle(rows)
    return [(i, t, s) for i, (t, s) in enumerate(rows)], items


def plain_quality(rows):
    lines = defaultdict(set)
    texts = defaultdict(set)
    normal = lambda line: " ".join(re.sub(r"[^\w\s]|_", "", re.sub(r"\d", "0", line.lower())).split())
    for _, t, s in rows:
        texts[s].add(t)
        for line in (t or "").split("\n"):
            if WORD.search(line):
                lines[s, normal(line)].add(t)
    often = {k for k, v in lines.items() if len(v) > 10 and 10 * len(v) > len(texts[k[0]])}
    kept = []
    for row in rows:
        words = WORD.findall(row[1] or "")
        grams = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
        covered = {j for i in range(len(words) - 7) if grams[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
        if len(words) < 20 or 100 * len(covered) > 30 * len(words):
            continue
        left = sum(len(WORD.findall(line)) for line in row[1].split("\n") if (row[2], normal(line)) not in often)
        if left < len(words) and (left < 20 or 100 * left < 30 * len(words)):
            continue
        kept.append(row)
    return kept


def plain_dedup(rows):
    sets = {i: shingles(t) for i, t, _ in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in sets:
        for b in sets:
            if a < b:
                shared = len(sets[a] & sets[b])
                if shared and 100 * shared >= 75 * len(sets[a] | sets[b]):
                    x, y = sorted((root(a), root(b)))
                    parent[y] = x
    return [r for r in rows if root(r[0]) == r[0]]


def plain_decontamination(rows, items):
    split = lambda t: re.sub(r"[^\w\s]", " ", t.lower()).split()
    return [r for r in rows if not any(smith_waterman(split(i), split(r[1])) >= len(split(i)) for i in items)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rows, items = corpus()
    path = str(tmp_path_factory.mktemp("tables"))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, source string").selectExpr("doc_id", "text", "'xx' AS lang", "source", "length(text) AS n_chars")
    frame.repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_pipeline(spark, folder):
    rows, items = corpus()
    good = plain_quality(rows)
    unique = plain_dedup(good)
    clean = plain_decontamination(unique, items)
    assert len(rows) > len(good) > len(unique) > len(clean) > 30

    docs, seen = spark.read.parquet(f"{folder}/documents.parquet"), []
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, folder).cache()
        assert docs.columns == columns
        seen.append(sorted(r.doc_id for r in docs.collect()))
    assert seen[0] == sorted(r[0] for r in good)
    assert seen[1] == sorted(r[0] for r in unique)
    assert seen[2] == sorted(r[0] for r in clean)
    before = spark.createDataFrame(clean, "doc_id bigint, text string, source string")
    taken = {r.doc_id: r.taken // r.size for r in mix_report(before).collect() if r.taken}
    assert Counter(seen[3]) == taken

    final = corpus_pipeline.run(spark, folder)
    assert final.columns == [*columns, "shard", "slot"]
    placed = final.collect()
    assert Counter(r.doc_id for r in placed) == taken
    text = {i: (t, s) for i, t, s in rows}
    assert all((r.text, r.source) == text[r.doc_id] for r in placed)
    by_shard = defaultdict(list)
    for r in placed:
        by_shard[r.shard].append(r.slot)
    assert set(by_shard) <= set(range(40)) and all(sorted(v) == list(range(len(v))) for v in by_shard.values())


@pytest.mark.parametrize("size", [100, 400])
def test_boilerplate_is_found_in_a_source_of_any_size(spark, documents, size):
    menu = "home news contact imprint terms privacy jobs press help search more"
    letters = lambda i: "".join(chr(97 + int(d)) for d in str(i))
    rows = [(i, " ".join(f"d{letters(i)}w{letters(j)}" for j in range(30))) for i in range(size)]
    rows += [(1000 + i, f"{menu}\n" + " ".join(f"m{letters(i)}w{letters(j)}" for j in range(12))) for i in range(12)]
    assert sorted(r.doc_id for r in corpus_pipeline.quality(spark, documents(rows), "").collect()) == list(range(size))


def test_empty_documents(spark, folder, tmp_path):
    spark.read.parquet(f"{folder}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{folder}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_registered_queries():
    numbers = sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES if n != "pipeline")
    assert numbers == list(range(1, 11)) and "pipeline" in QUERIES and set(ORACLE) < set(QUERIES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "near-dedup", "decontamination", "mixing", "sharding"]
