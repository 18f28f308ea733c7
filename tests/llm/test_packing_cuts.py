"""Remainders that are cut once more where whole ones would leave much padding."""

import random
import zlib

import numpy as np
import pytest

from clickmill.llm import packing


def padding(made):
    used = [(sum(n * each for n, each in pattern.items()), times) for pattern, times in made]
    padded = sum((1 << (n - 1).bit_length()) * times for n, times in used)
    return 1 - sum(n * times for n, times in used) / padded


def test_checksum_of_the_rest_follows_from_the_beginning():
    draw = random.Random(2)
    for _ in range(200):
        ids = draw.randbytes(4 * draw.randint(2, 300))
        at = 4 * draw.randint(1, len(ids) // 4 - 1)
        rest = packing.rest_checksum(zlib.crc32(ids), zlib.crc32(ids[:at]), len(ids) // 4 - at // 4)
        assert rest == zlib.crc32(ids[at:])


@pytest.mark.parametrize(
    "lengths", [[520] * 1000, [1000] * 500, [700] * 900 + [600] * 400, list(range(520, 700)) * 8, [520]]
)
def test_plan_places_every_part_with_little_padding(lengths):
    counts = {n: lengths.count(n) for n in set(lengths)}
    cuts, made = packing.plan(counts)
    got = {}
    for pattern, times in made:
        assert sum(n * each for n, each in pattern.items()) <= 1024
        for n, each in pattern.items():
            got[n] = got.get(n, 0) + each * times
    assert got == {n: c for n, c in packing.after_cuts(counts, cuts).items() if c}
    for n, c in counts.items():
        assert sum(times for (whole, _), times in cuts.items() if whole == n) <= c
    if len(lengths) > 1:
        assert padding(made) < 0.02 < padding(packing.patterns(counts)) + 0.01
    else:
        assert not cuts


def test_ranks_of_parts_follow_those_of_whole_pieces_without_gaps():
    counts = {520: 30, 260: 5, 16: 2}
    cuts = {(520, 256): 7, (520, 496): 4, (260, 16): 3}
    table = packing.cut_table(counts, cuts)
    ranks = {n: list(range(c)) for n, c in counts.items()}
    for whole, rank, first, a, b in zip(*table.values()):
        times = cuts[whole, first]
        assert set(range(rank, rank + times)) <= set(ranks[whole])
        ranks[whole] = [r for r in ranks[whole] if not rank <= r < rank + times]
        for n, start in ((first, a), (whole - first, b)):
            ranks.setdefault(n, []).extend(range(start, start + times))
    assert {n: sorted(r) for n, r in ranks.items()} == {
        n: list(range(c)) for n, c in packing.after_cuts(counts, cuts).items()
    }


def test_one_length_table_is_packed_with_every_id_in_one_piece(docs):
    draw = random.Random(8)
    encoder = packing.Encoder(packing.public_vocabulary())
    rows = [(i % 300, " ".join(draw.choice(["red", "blue", "green", "old"]) for _ in range(539))) for i in range(320)]
    rows += [(None, "a b"), (7, None), (9, "one " * 3000)]
    ids = [np.frombuffer(encoder.whole(body or "") + b"\0\0\0\0", "<u4") for _, body in rows]
    got = packing.pack(docs(rows), packing.public_vocabulary()).collect()
    held = {}
    for r in got:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    used = []
    for places in held.values():
        places.sort()
        assert [o for o, _ in places] == list(np.cumsum([0, *(n for _, n in places)])[:-1])
        used.append(sum(n for _, n in places))
        assert used[-1] <= 1024
    assert sum(1 << (n - 1).bit_length() for n in used) < 1.02 * sum(used)
    whole = sum(len(x) for x in ids)
    assert sum(used) == whole and any(r.start % 1024 for r in got)
    # Every document is made of its pieces: starts without gaps, checksums of those very ids.
    by_id = {}
    for (doc_id, _), x in zip(rows, ids):
        by_id.setdefault(doc_id, []).append(x)
    for doc_id, texts in by_id.items():
        mine = {(r.start, r.length, r.ids_crc32) for r in got if r.doc_id == doc_id}
        for x in texts:
            at = 0
            while at < len(x):
                own = [p for p in mine if p[0] == at and zlib.crc32(x[at : at + p[1]].tobytes()) == p[2]]
                assert own and at + own[0][1] <= len(x)
                at += own[0][1]
        total = sum(r.length for r in got if r.doc_id == doc_id)
        assert total == sum(len(x) for x in texts)
