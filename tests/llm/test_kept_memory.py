"""What a packing task keeps in a Python worker is there for the next one, and goes when other tasks run there."""

import pyarrow as pa

from riskloom.llm import common, packing


def test_other_tasks_forget_the_tokenizer():
    path = packing.default_tokenizer()
    frame = pa.RecordBatch.from_pydict({"x": [1]})

    def words_known(frames):
        for _ in frames:
            packing.word_tokens(path).ids_of([b"some words"])
            yield pa.RecordBatch.from_pydict({"n": [len(packing.word_tokens(path).words.young)]})

    def other(frames):
        for _ in frames:
            yield pa.RecordBatch.from_pydict({"n": [packing.word_tokens.cache_info().currsize]})

    first = lambda run: next(iter(run([frame]))).column("n")[0].as_py()
    packing.word_tokens.cache_clear()  # other tests have used it
    packing.word_tokens(path).ids_of([b"kept before"])
    assert first(common.trimmed(words_known, keep=True)) == 4
    assert first(common.trimmed(other)) == 0
    assert first(common.trimmed(words_known, keep=True)) == 2
