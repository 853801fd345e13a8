import hashlib
import random
import re

import xxhash

from folioscan.llm import simhash
from folioscan.llm.queries import simhash_rows


def words_hash(words, seed=42):
    for word in words:
        seed = xxhash.xxh64_intdigest(word.encode(), seed)
    return seed


def second(words):
    # The literal 1 is an int: its hash is folded in after the words, as Spark hashes 4 bytes.
    return xxhash.xxh64_intdigest((1).to_bytes(4, "little"), words_hash(words))


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    runs = [words[i : i + 5] for i in range(max(len(words) - 4, 1))] if words else []
    bits = ""
    for hashes in ([words_hash(r) for r in runs], [second(r) for r in runs]):
        bits += "".join("01"[2 * sum(h >> b & 1 for h in hashes) > len(hashes)] for b in range(63, -1, -1))
    return f"{int(bits, 2):032x}"


def test_contract_equals_brute_force(awkward, nothing, spark):
    rows = sorted(
        [(r.doc_id, r.text) for r in awkward.collect()],
        key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""),
    )
    texts = [t or "" for _, t in rows]
    want = []
    for i, (doc_id, _) in enumerate(rows):
        text, following = texts[i], texts[(i + 1) % len(texts)]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        prints = [int(brute(t), 16) for t in (text, edited, following)]
        near = [1 - (prints[0] ^ other).bit_count() / 128 for other in prints[1:]]
        want.append((str(doc_id), len(text), hashlib.sha256(edited.encode()).hexdigest(), brute(text), brute(edited), *near))
    columns = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    for slots in (1, 5):
        got = simhash.digest(simhash_rows(awkward, slots)).select(*columns).collect()
        assert sorted((str(r[0]), *r[1:]) for r in got) == sorted(want)
    assert simhash.digest(simhash_rows(nothing, 4)).count() == 0


def test_near_pairs_equal_all_pairs(spark):
    random.seed(3)
    centres = [random.getrandbits(128) for _ in range(40)]
    prints = set(centres)
    for c in centres:
        for flips in (1, 2, 3, 4, 5):
            prints.add(c ^ sum(1 << b for b in random.sample(range(128), flips)))
    signed = lambda v: v - 2**64 if v >= 2**63 else v
    rows = [(signed(p >> 64), signed(p % 2**64)) for p in prints]
    table = spark.createDataFrame(rows + rows[:10] + [(None, 1)], "high long, low long")
    for radius, blocks in ((3, 5), (3, 4), (0, 1), (2, 6)):
        got = simhash.near_pairs(table, radius, blocks).collect()
        want = sum((a ^ b).bit_count() <= radius for a in prints for b in prints if a < b)
        assert len(got) == want == len({r[:4] for r in got})
    assert simhash.near_pairs(table.limit(0)).count() == 0


def test_radius_holds_few_edited_copies():
    """The recall that README and module state, with this operator's own hashes."""
    random.seed(5)
    word = lambda: "".join(random.choice("abcdefghij") for _ in range(4))
    apart = []
    for _ in range(60):
        text = [word() for _ in range(244)]
        edited = list(text)
        for _ in range(3):
            edited[random.randrange(244)] = word()
        prints = [int(brute(" ".join(t)), 16) for t in (text, edited)]
        apart.append((prints[0] ^ prints[1]).bit_count())
    assert sum(d <= simhash.RADIUS for d in apart) < 0.1 * 60 < 0.8 * 60 < sum(d <= 20 for d in apart)
