"""What operators hold on disk and in workers while they run."""

from __future__ import annotations

import os

import pyarrow as pa

from lumbung.llm import fertility, jaccard_join, packing
from lumbung.llm.common import Scratch
from lumbung.session import DROP_SHUFFLES


def test_the_similarity_join_drops_what_it_has_read(spark, monkeypatch):
    held, settings = {}, set()
    keep = Scratch.keep

    def noted(self, df, name):
        settings.add((self.codec, spark.conf.get(DROP_SHUFFLES, None)))
        out = keep(self, df, name)
        held[name] = set(os.listdir(self.folder.removeprefix("file:")))
        return out

    monkeypatch.setattr(Scratch, "keep", noted)
    before = spark.conf.get(DROP_SHUFFLES, None)
    words = [f"w{i}" for i in range(40)]
    texts = [" ".join(words), " ".join([*words, "end"]), " ".join(["start", *words]), "a text of another kind", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    assert sorted(r["doc_id"] for r in jaccard_join.one_of_each(docs).collect()) == [0, 3, 4]
    assert settings == {("zstd", "true")} and spark.conf.get(DROP_SHUFFLES, None) == before
    assert "signed" in held["members"] and "signed" not in held["stars"]
    assert "star_sets" not in held["pairs_16"] and held["ids"] >= {"digests", "classes", "signs"}


def test_workers_remember_200_000_parts_at_most(monkeypatch):
    caps = []
    for module in (packing, fertility):
        made = module.byte_bpe_ranks
        monkeypatch.setattr(module, "byte_bpe_ranks", lambda *a, make=made, **k: caps.append(k.get("cap")) or make(*a, **k))
    rows = pa.RecordBatch.from_pydict({"doc_id": [1], "text": ["one two two"]})
    assert [b.column("tokens").to_pylist() for b in packing._count(None)(iter([rows]))] == [[4]]
    assert [b.column("n_words").to_pylist() for b in fertility._measure(None, None)(iter([rows]))] == [[3]]
    assert caps == [200_000, 200_000]
