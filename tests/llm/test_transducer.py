"""The transducer's work: what a suffix and a byte allow is worked out once, and nothing is left to the collector."""

import gc
import random

import public_tokenizers
import pytest

from hushwire.llm import bpe


@pytest.fixture(scope="module")
def ranks():
    return bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def pieces(n):
    r = random.Random(4)
    return [(" " + "".join(r.choice(["th", "e", "an", "ing", "tion", "ou", "éa", "x"]) for _ in range(r.randint(1, 6)))).encode() for _ in range(n)]


def test_shapes_are_worked_out_once(ranks, monkeypatch):
    made = []
    monkeypatch.setattr(bpe.Transducer, "shape", lambda self, place, byte, f=bpe.Transducer.shape: made.append((place.suffix, byte)) or f(self, place, byte))
    machine = bpe.Transducer(ranks)
    for p in pieces(3000):
        machine.encode_packed(p)
    arcs = sum(len(s) for p in machine.places.values() for s in p.states.values())
    assert len(made) == len(set(made)) < arcs


def test_packed_ids_across_resets(ranks):
    machine = bpe.Transducer(ranks, most=50)
    for p in [*pieces(300), b" " + b"tionthe" * 100]:
        want = bpe.merge(ranks, p) if p not in ranks else [ranks[p]]
        assert machine.encode_packed(p) == b"".join(i.to_bytes(4, "little") for i in want)
        assert machine.encode(p) == want


def test_reset_leaves_no_states(ranks):
    machine = bpe.Transducer(ranks, most=10)
    gc.collect()
    gc.disable()
    try:
        for p in pieces(200):
            machine.encode_packed(p)
        machine.reset()
        # states of machines that other tests keep are none of ours; our own has its start alone
        assert sum(isinstance(o, bpe.State) and o.machine is machine for o in gc.get_objects()) == 1
    finally:
        gc.enable()
