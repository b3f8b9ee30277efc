import random
import re

import xxhash

from tests.llm.cases import no_documents, odd_documents
from tripweave.llm import simhash
from tripweave.llm.components import connected_components
from tripweave.llm.queries import op7_simhash_near_dedup


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, near):
    """Smallest reachable id of each position."""
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a in range(len(ids)):
        for b in range(a):
            if near(a, b):
                root[find(a)] = find(b)
    least = {}
    for at, name in enumerate(ids):
        least[find(at)] = min(name, least.get(find(at), name))
    return [least[find(at)] for at in range(len(ids))]


def test_whole_table(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    prints = [plain_fingerprint(d.text) for d in docs]
    ids = [d.doc_id for d in docs]
    parts = plain_components(ids, lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2)
    wanted = sorted((i, f"{p:016x}", c) for i, p, c in zip(ids, prints, parts, strict=True))
    assert sorted(map(tuple, op7_simhash_near_dedup(spark, small).collect())) == wanted


def test_large_buckets_lose_no_link(spark):
    draw = random.Random(7)
    prints = {draw.getrandbits(64) for _ in range(40)}
    for centre in list(prints)[:3]:  # dense balls: more fingerprints than a bucket holds
        for _ in range(400):
            prints.add(centre ^ sum(1 << b for b in draw.sample(range(64), draw.randint(1, 4))))
        for _ in range(200):
            prints.add(centre ^ sum(1 << b for b in draw.sample(range(32), draw.randint(1, 3))))
    signed = sorted(p - (1 << 64) * (p >> 63) for p in prints)
    frame = spark.createDataFrame([(p,) for p in signed], "fp long")
    links = simhash.fingerprint_links(frame).collect()
    assert all((a ^ b).bit_count() <= 2 for a, b in ((r.src & (2**64 - 1), r.dst & (2**64 - 1)) for r in links))
    found = {r.node: r.component for r in connected_components(spark.createDataFrame(links)).collect()}
    wanted = plain_components(
        signed, lambda a, b: ((signed[a] ^ signed[b]) & (2**64 - 1)).bit_count() <= 2
    )
    assert [found.get(p, p) for p in signed] == wanted


def test_odd_rows(spark):
    docs = odd_documents(spark)
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == docs.count()
    texts = dict(docs.select("doc_id", "text").collect())
    for row in rows:
        assert row.fp & (2**64 - 1) == plain_fingerprint(texts[row.doc_id])
    # null, empty and blank texts are copies of each other
    assert {r.component_id for r in rows if r.doc_id in (2, 3, 4)} == {2}
    assert simhash.near_duplicates(no_documents(spark)).count() == 0


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(100, 160)]
    star = [(7, i) for i in range(200, 400)] + [(7, 7), (200, 7)]
    frame = spark.createDataFrame(path + star, "src long, dst long")
    found = {r.node: r.component for r in connected_components(frame).collect()}
    assert found == {i: 100 for i in range(100, 161)} | {i: 7 for i in (7, *range(200, 400))}
