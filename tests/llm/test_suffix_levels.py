"""The registered query merges levels and scans against a merged one."""

from windrow.llm import registry, suffix_family


def test_the_query_scans_a_batch_against_a_merged_level(spark, monkeypatch):
    seen, add = [], suffix_family.SuffixFamily.add

    def watched(self, docs, keep=True):
        seen.append(list(self.sizes))
        return add(self, docs, keep)

    monkeypatch.setattr(suffix_family.SuffixFamily, "add", watched)
    docs = spark.createDataFrame([(i, "abc" * i) for i in range(16)], "doc_id bigint, text string")
    monkeypatch.setattr(registry, "table", lambda *a: docs)
    assert registry.op3_suffix_dedup(spark, "").count() == 16
    assert seen[-1] == [2]
