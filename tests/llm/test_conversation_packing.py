"""Conversations in sequences under three limits."""

import collections
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerglass.llm import conversation_packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def turns():
    rng = random.Random(6)
    words = "the of and question answer because first second please write code number".split()
    rows = []
    for c in range(120):
        for t in range(rng.randrange(1, 9)):
            n = rng.choice([3, 20, 60, 200, 400])
            rows.append((c, t, ["user", "assistant"][t % 2], " ".join(rng.choice(words) for _ in range(n))))
    rows += [(500, t, ["user", "assistant"][t % 2], "again " * 40) for t in range(400)]  # one conversation with most turns
    rows += [rows[0], rows[0], (None, 0, "assistant", "no conversation"), (501, None, None, "no turn"), (502, 1, "assistant", None), (502, 2, "user", ""), (503, 0, "assistant", "long " * 9000)]
    return rows


@pytest.mark.parametrize("limits", [(2048, 8, 1024), (512, 64, 100), (4096, 3, 4096)])
def test_every_limit_holds_and_every_id_is_there_once(spark, limits):
    rows = turns()
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, length int, segment string").repartition(3)
    got = conversation_packing.pack_conversations(df, PATH, limits=limits).collect()
    tokenizer = Tokenizer.from_file(PATH)
    want = collections.Counter()
    for c, t, role, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        size = max(1, min(limits[0], limits[2]) // 2) if role == "assistant" else limits[0] // 2
        for a in range(0, len(ids), size):
            part = ids[a : a + size]
            want[c, t, role, a, len(part), len(part) if role == "assistant" else 0, zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert collections.Counter((r.conv_id, r.turn, r.role, r.start, r.length, r.loss, r.ids_crc32) for r in got) == want
    sequences = collections.defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append(r)
    reached = np.zeros(3)
    for some in sequences.values():
        some.sort(key=lambda r: r.offset)
        assert [r.offset for r in some] == [0, *np.cumsum([r.length for r in some])[:-1]]
        used = np.array([sum(r.length for r in some), len(some), sum(r.loss for r in some)])
        assert (used <= limits).all()
        reached = np.maximum(reached, used / limits)
    # the limit that is scarce here binds
    assert reached.max() > 0.97
    if limits[1] == 3:
        assert reached[1] == 1


def test_no_turns(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert conversation_packing.pack_conversations(df, PATH).count() == 0
