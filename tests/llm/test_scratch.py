"""What operators leave on disk: shuffle files of ended writes, and scratch tables that nothing reads any more."""

import os
import random

import corpus_pipeline
import numpy as np
import pytest

from cairnlake.llm import chosen_path, stream_dedup
from cairnlake.llm.scratch import discard, stored
from cairnlake.session import SHUFFLE_CLEANUP, scratch_path, without_shuffle_files

SCHEMA = "doc_id long, text string"


def shuffle_files(spark) -> set[str]:
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for i in range(files.size()) if (name := files.apply(i).getName()).startswith("shuffle_")}


def scratch_labels(spark) -> dict[str, str]:
    """Folder and label of every scratch table there is."""
    top = os.path.dirname(scratch_path(spark, "x"))
    return {name: name[:-33] for name in (os.listdir(top) if os.path.isdir(top) else [])}


@pytest.fixture
def near_copies(spark):
    draw = random.Random(5)
    base = [[f"w{draw.randint(0, 400)}" for _ in range(60)] for _ in range(20)]
    rows = [(i, " ".join([*base[i % 20], f"copy{i}"])) for i in range(120)]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def test_stored_leaves_no_shuffle_files(spark):
    before, option = shuffle_files(spark), spark.conf.get(SHUFFLE_CLEANUP, None)
    table = stored(spark.range(5000).selectExpr("id % 50 as k", "id").groupBy("k").count(), "kept")
    assert not shuffle_files(spark) - before
    assert spark.conf.get(SHUFFLE_CLEANUP, None) == option
    assert table.count() == 50


def test_setting_is_restored_after_a_failure(spark):
    option = spark.conf.get(SHUFFLE_CLEANUP, None)
    with pytest.raises(ZeroDivisionError):
        with without_shuffle_files(spark):
            1 / 0
    assert spark.conf.get(SHUFFLE_CLEANUP, None) == option


def test_a_table_is_shuffled_again_where_it_is_read_again(spark):
    counted = spark.range(1000).selectExpr("id % 10 as k").groupBy("k").count()
    first, second = stored(counted, "once"), stored(counted, "twice")
    assert sorted(first.collect()) == sorted(second.collect()) == sorted(counted.collect())
    discard(first)
    assert second.count() == 10


def test_near_duplicates_leave_what_their_result_reads(spark, near_copies):
    before = scratch_labels(spark)
    found = chosen_path.link_documents(near_copies)
    left = sorted(label for name, label in scratch_labels(spark).items() if name not in before)
    assert left == ["set-components", "shingle-sets"]
    assert {r.component_id for r in found.collect()} == set(range(20))


def test_exact_copies_leave_no_texts(spark, near_copies):
    before = scratch_labels(spark)
    found = stream_dedup.deduplicate(near_copies.unionByName(near_copies.selectExpr("doc_id + 1000 as doc_id", "text")))
    left = {label for name, label in scratch_labels(spark).items() if name not in before}
    assert not left & {"dedup-content", "dedup-best"}
    assert {(r.doc_id % 1000, r.keep_id, r.group_size) for r in found.collect()} == {(i, i, 2) for i in range(120)}


def test_a_large_cluster_is_dealt_out_in_passes(spark, near_copies, monkeypatch):
    """Six documents in blocks of one: a text is dealt out six times, 1.5 times in each pass."""
    whole = sorted(chosen_path.link_documents(near_copies).collect())
    dealt, store = [], chosen_path.stored

    def watched(table, label):
        if label == "cluster-edges":
            dealt.append(label)
        return store(table, label)

    monkeypatch.setattr(chosen_path, "BLOCK", 1)
    monkeypatch.setattr(chosen_path, "stored", watched)
    assert sorted(chosen_path.link_documents(near_copies).collect()) == whole
    assert len(dealt) == 4


def test_packed_sketches_agree_as_coordinates_do():
    draw = np.random.default_rng(3)
    coordinates = draw.integers(0, 2**32, (40, chosen_path.COORDINATES), dtype=np.uint32)
    coordinates[1:, ::3] = coordinates[0, ::3]
    plain = (coordinates & 15).astype(np.uint8)
    packed = chosen_path.packed_sketch(coordinates)
    assert packed.nbytes * 8 == coordinates.nbytes
    back = chosen_path.unpacked_sketch(packed)
    for i in range(40):
        assert ((back == back[i]).sum(axis=1) == (plain == plain[i]).sum(axis=1)).all()


def test_groups_are_cut_by_their_texts(spark, near_copies, monkeypatch):
    """Groups that are too large to be read together give the same components."""
    whole = sorted(chosen_path.link_documents(near_copies).collect())
    monkeypatch.setattr(chosen_path, "CHUNK_BYTES", 700)
    assert sorted(chosen_path.link_documents(near_copies).collect()) == whole


def test_pipeline_keeps_the_last_documents_only(spark):
    before = scratch_labels(spark)
    found = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    left = [label for name, label in scratch_labels(spark).items() if name not in before and label.startswith("pipeline-")]
    assert left == ["pipeline-mix"]
    assert found.count() > 100
