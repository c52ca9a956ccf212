"""What tasks hold while they run, and after."""

import gc
import tracemalloc
import weakref

import numpy as np
import pyarrow as pa

from flowlake.llm import common, langid, neardup, pii
from tests.llm.helpers import prose


def peak_mb(run):
    common._powers.clear()
    gc.collect()
    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_chunks_of_texts_take_little_memory():
    column = pa.array([prose(k, 5_000, 20_000) for k in range(40)])
    assert column.nbytes > 1 << 20
    rnd = np.random.default_rng(3)
    model = langid.Model(["de", "en", "fr", "nl"], rnd.integers(1, 50, (langid.BUCKETS, 4)).astype(float),
                         np.ones((len(langid.SCRIPT_NAMES), 4)), np.ones(4))
    langid._letters()
    assert peak_mb(lambda: sum(len(x[2]) for x in langid.Labeller(model).rows(column))) < 60
    assert peak_mb(lambda: sum(len(s) for s, _ in neardup.shingle_sets(column, 5))) < 20


def test_a_task_releases_memory_when_its_variables_are_gone(monkeypatch):
    alive, released_at = [], []

    def run(batches):
        class Held:
            pass
        held = Held()
        alive.append(weakref.ref(held))
        for batch in batches:
            yield batch

    def release():
        gc.collect()
        released_at.append(alive[0]() is None)

    monkeypatch.setattr(common, "release_memory", release)
    assert list(common.released(run)(iter([1, 2]))) == [1, 2] and released_at == [True]


def test_released_memory_leaves_the_process():
    def held():
        with open("/proc/self/statm") as f:
            return int(f.read().split()[1]) * 4096 / 1e6

    many = [np.ones(8_000) for _ in range(3_000)]       # 64 kB each: from the heap, not mapped
    kept = many[-1]                                      # stands at the heap's top, so nothing is trimmed by itself
    full = held()
    del many
    common.release_memory()
    assert full - held() > 100 and len(kept) == 8_000


def test_masked_texts_leave_in_small_batches():
    class Docs:
        schema, columns = None, ["doc_id", "text"]

        def mapInArrow(self, run, schema):
            return run

    texts = [None, *(f"{prose(k, 5_000)} me{k}@mail.example.com" for k in range(120)), ""]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts})
    out = list(pii.mask_personal_data(Docs(), pii.Model([]))(iter([batch])))
    assert len(out) > 2 and sum(x.num_rows for x in out) == len(texts)
    assert [t and t[-7:] for x in out for t in x.column("text").to_pylist()] == [None, *["[EMAIL]"] * 120, ""]
