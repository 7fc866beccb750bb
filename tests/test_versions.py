import pytest
from conftest import rows

from lodgelex.plans import markets
from lodgelex.sources.tables import save_tables
from lodgelex.sources.versions import NotPublished, current, manifests, publish


def writer(spark, *sizes):
    return lambda folder: save_tables({f"t{i}": spark.range(n) for i, n in enumerate(sizes)}, folder)


def test_the_last_version_is_read(spark, tmp_path):
    folder = str(tmp_path)
    with pytest.raises(NotPublished):
        current(spark, folder)
    first = publish(spark, folder, writer(spark, 2, 3))
    assert current(spark, folder) == first and first.tables == ("t0", "t1")
    second = publish(spark, folder, writer(spark, 5))
    assert current(spark, folder) == second
    assert second.load(spark, "t0").count() == 5
    assert first.load(spark, "t0").count() == 2, "who holds a version goes on reading it"
    with pytest.raises(NotPublished, match="t1"):
        second.load(spark, "t1")
    assert manifests(spark, folder).count() == 2


def test_a_failed_run_changes_nothing(spark, tmp_path):
    folder = str(tmp_path)
    first = publish(spark, folder, writer(spark, 2))

    def fails(target):
        writer(spark, 9)(target)
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError, match="lost"):
        publish(spark, folder, fails)
    assert current(spark, folder) == first and manifests(spark, folder).count() == 1


def test_a_manifest_under_way_is_not_read(spark, tmp_path):
    folder = str(tmp_path)
    (tmp_path / "manifests" / "x" / "_temporary").mkdir(parents=True)
    (tmp_path / "manifests" / "x" / "_temporary" / "part-0.parquet").write_text("half")
    with pytest.raises(NotPublished):
        current(spark, folder)
    first = publish(spark, folder, writer(spark, 2))
    assert current(spark, folder) == first


def test_overlapping_runs(spark, tmp_path):
    folder, inner = str(tmp_path), []

    def outer(target):
        inner.append(publish(spark, folder, writer(spark, 3)))
        return writer(spark, 4)(target)

    last = publish(spark, folder, outer)
    assert current(spark, folder) == last and last.load(spark, "t0").count() == 4
    assert inner[0].load(spark, "t0").count() == 3


def test_a_clock_behind_does_not_hide_a_version(spark, tmp_path, monkeypatch):
    folder = str(tmp_path)
    publish(spark, folder, writer(spark, 1))
    monkeypatch.setattr("lodgelex.sources.versions.time.time_ns", lambda: 5)
    publish(spark, folder, writer(spark, 2))
    assert current(spark, folder).load(spark, "t0").count() == 2


def test_batch_run_as_a_version(spark, tmp_path, make, words_of):
    flat = make(*[{"text": t} for t in ("red house near sea", "blue house near park", "red sea")])
    lexicons = markets.Lexicons(words_of["afinn"], words_of["bing"], words_of["nrc"])
    version = markets.publish_tables(flat, str(tmp_path), "en", words_of["stop"], lexicons)
    assert version == current(spark, str(tmp_path))
    assert rows(version.load(spark, "total_documents"), "total_documents") == [(3,)]
    assert version.load_topic_model().vocabSize() > 0
