import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from helpers import SF, awkward, documents, nothing

from hourweave.llm.packing import best_fit, op4_packing, pack, place, plan, reduce, slots

PATH = str(public_tokenizers.path("word_bpe_49k.json"))


def expected_pieces(rows, capacity=4096):
    from tokenizers import Tokenizer

    out = Counter()
    encoded = Tokenizer.from_file(PATH).encode_batch([t or "" for _, t in rows], add_special_tokens=False)
    for (doc_id, _), e in zip(rows, encoded, strict=True):
        ids = [*e.ids, 1]
        for k, a in enumerate(range(0, len(ids), capacity)):
            part = ids[a:a + capacity]
            out[doc_id, k, a, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    return out


def check(rows, want, capacity=4096):
    """The pieces are those wanted and lie gapless in their sequences; gives the number of sequences."""
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_query_packs_every_piece_tightly(spark):
    rows, want = op4_packing(spark, SF).collect(), expected_pieces(documents())
    total = sum(n * k for (_, _, _, n, _), k in want.items())
    assert check(rows, want) <= -(-total // 4096) + 1


def test_awkward_documents_and_small_sequences(spark):
    docs = awkward(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    for capacity in (1, 7, 100):
        check(pack(docs, PATH, 1, capacity).collect(), expected_pieces(rows, capacity), capacity)
    assert pack(nothing(spark), PATH).count() == 0
    kept = pack(docs, PATH, keep_ids=True).first()
    assert zlib.crc32(kept["ids"]) == kept["ids_crc32"]


def least(counts, capacity):
    """Fewest sequences, by exhaustion."""
    items = tuple(sorted((n for n, c in counts.items() for _ in range(c)), reverse=True))
    best = [len(items)]

    def go(i, rooms):
        if len(rooms) >= best[0] and i < len(items):
            return
        if i == len(items):
            best[0] = min(best[0], len(rooms))
            return
        for room in set(rooms):
            if room >= items[i]:
                rest = list(rooms)
                rest.remove(room)
                go(i + 1, [*rest, room - items[i]])
        go(i + 1, [*rooms, capacity - items[i]])

    go(0, [])
    return best[0]


def test_reduction_never_costs_a_sequence():
    r = random.Random(4)
    for _ in range(300):
        capacity = r.randint(5, 24)
        counts = Counter(r.randint(1, capacity) for _ in range(r.randint(1, 9)))
        rest = dict(counts)
        fixed = reduce(rest, capacity)
        assert sum(c for c, _ in fixed) + least(rest, capacity) == least(counts, capacity)
        for found in (plan(dict(counts), capacity), best_fit(dict(counts), capacity)):
            assert all(sum(n * k for n, k in p) <= capacity for _, p in found)
            assert sum((Counter({n: k * c for n, k in p}) for c, p in found), Counter()) == counts


def test_places_are_a_packing_for_any_histogram():
    r = random.Random(5)
    counts = Counter(min(64, max(1, int(r.lognormvariate(2.5, 1)))) for _ in range(3000))
    length = np.repeat(list(counts), list(counts.values()))
    rank = np.concatenate([np.arange(c) for c in counts.values()])
    sequence, offset = place(slots(plan(counts, 64)), length, rank)
    ends = defaultdict(int)
    for s, o, n in sorted(zip(sequence.tolist(), offset.tolist(), length.tolist(), strict=True)):
        assert o == ends[s]
        ends[s] += n
    assert max(ends.values()) <= 64 and len(ends) <= -(-length.sum() // 64) + 1
