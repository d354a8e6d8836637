import zlib
from collections import defaultdict

import numpy as np

from smelter.llm.sharding import jump, shard
from tests.llm.conftest import rows


def plain_jump(key: int, shards: int) -> int:
    at, ahead = -1, 0
    while ahead < shards:
        at = ahead
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        ahead = int((at + 1) * ((1 << 31) / ((key >> 33) + 1)))
    return at


def test_jump_equals_the_plain_loop_and_only_moves_to_new_shards():
    keys = np.random.default_rng(1).integers(0, 1 << 63, 3000).astype(np.uint64)
    for shards in (1, 2, 24, 1000):
        got = jump(keys.copy(), shards)
        assert got.tolist() == [plain_jump(int(k), shards) for k in keys]
        grown = jump(keys.copy(), shards + 1)
        assert set(grown[grown != got].tolist()) <= {shards}
    counts = np.bincount(jump(keys.copy(), 24), minlength=24)
    assert counts.min() > 80 and counts.max() < 180


def test_every_row_has_a_slot_of_its_own(odd_docs):
    got = rows(shard(odd_docs), "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
    assert len(got) == odd_docs.count()
    slots, shards = defaultdict(list), defaultdict(set)
    for doc_id, _, _, law, at, slot, grown in got:
        assert law == "key" and grown in (at, 24)
        slots[at].append(slot)
        shards[doc_id].add(at)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in shards.values())
    texts = {(r.doc_id, 8 + len((r.text or "").encode()), zlib.crc32((r.text or "").encode())) for r in odd_docs.collect()}
    assert {g[:3] for g in got} == texts


def test_an_empty_table(odd_docs):
    assert shard(odd_docs.limit(0)).count() == 0
