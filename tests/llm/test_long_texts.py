"""Hashes of very long texts, worked out block by block."""

import random
import subprocess
import sys

import numpy as np
import pyarrow as pa
import pytest

from oeeflow.llm import shingles


@pytest.mark.parametrize("block", [1, 2, 3, 7, 64, 1000])
def test_blocks_give_the_hashes_of_the_whole(block, monkeypatch):
    rng = random.Random(block)
    texts = ["", " ", "a", " a ", "ab" * 500, "x" * 64 + " " + "y" * 63 + "  " + "z" * 65]
    texts += ["".join(rng.choice("aB \u00e9\n\t") for _ in range(rng.randrange(300))) for _ in range(40)]
    column = pa.array([*texts, None])

    def taken():
        return [h for _, words, at in shingles.word_hashes(column) for h in
                (words[lo:hi].tolist() for lo, hi in zip(at[:-1], at[1:]))], [x.tolist() for x in shingles.shingle_sets(column, 4)]
    whole = taken()
    assert [len(h) for h in whole[0][:-1]] == [len(t.split()) for t in texts]
    monkeypatch.setattr(shingles, "CHUNK_BYTES", block)
    assert taken() == whole


def test_windows_in_blocks():
    words = np.arange(1000, dtype=np.uint64)
    assert all((shingles._windows(words, 5, block) == shingles._windows(words, 5)).all() for block in (1, 7, 996, 5000))


def test_memory_of_a_long_text():
    code = ("import resource, sys, pyarrow as pa; sys.path.insert(0, {0!r}); from oeeflow.llm.shingles import shingle_sets; "
            "text = pa.array([' '.join(map(str, range(4_000_000)))]); used = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss; "
            "n = sum(len(x) for x in shingle_sets(text, 5)); assert n == 3_999_996; "
            "print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - used) // 1024)")
    root = shingles.__file__.rsplit("/", 3)[0]
    out = subprocess.run([sys.executable, "-c", code.format(root)], capture_output=True, text=True, check=True).stdout
    assert int(out) < 250, out  # a text of 31 MB; every array of one number a byte would take as much
