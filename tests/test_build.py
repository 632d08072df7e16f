import io
import random
import tarfile

import numpy as np
import pytest
from pyspark.errors import AnalysisException

from corpuscle.functions import membership as mb
from corpuscle.plans.pipeline import run_build
from corpuscle.sources import articles, tables
from corpuscle.sources.manifest import Manifest, content_digest


def _articles(n=4, per=20):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(300)]
    out = []
    for c in range(n):
        for i in range(per):
            body = " ".join(rng.choices(words[c * 60 : c * 60 + 90], k=45 + i))
            out.append((f"cat{c}", str(i), f"From: x\nSubject: y\n\n{body}\n> q\n--\nsig \xe9"))
    return out


@pytest.fixture(scope="module")
def places(tmp_path_factory):
    top = tmp_path_factory.mktemp("articles")
    with tarfile.open(top / "all.tar.gz", "w:gz") as archive:
        for category, name, text in _articles():
            data = text.encode("latin-1")
            folder = top / "corpus" / category
            folder.mkdir(parents=True, exist_ok=True)
            (folder / name).write_bytes(data)
            info = tarfile.TarInfo(f"corpus/{category}/{name}")
            info.size = len(data)
            archive.addfile(info, io.BytesIO(data))
        stray = tarfile.TarInfo("corpus/readme")
        archive.addfile(stray, io.BytesIO(b""))
    return top


def test_archive(spark, places):
    rows = articles.read_archives(spark, str(places / "all.tar.gz")).orderBy("doc_seq").collect()
    assert [(r["category"], r["doc_id"].split("/")[1], r["text"]) for r in rows] == _articles()
    assert [r["doc_seq"] for r in rows] == list(range(len(rows)))


def test_folder_of_archives_is_read_in_name_order(spark, tmp_path):
    for name in ("b.tgz", "a.tar"):
        with tarfile.open(tmp_path / name, "w:gz" if name.endswith("tgz") else "w") as archive:
            info = tarfile.TarInfo(f"r/{name[0]}/1")
            archive.addfile(info, io.BytesIO(b""))
    (tmp_path / "note.txt").write_text("not an archive")
    rows = articles.read_archives(spark, str(tmp_path)).orderBy("doc_seq").collect()
    assert [r["category"] for r in rows] == ["a", "b"]


def test_tree(spark, places):
    rows = articles.read_tree(spark, str(places / "corpus")).orderBy("doc_seq").collect()
    expected = sorted(_articles(), key=lambda a: (a[0], a[1]))
    assert [(r["category"], r["doc_id"].split("/")[1], r["text"]) for r in rows] == expected


def test_absent_collection_fails(spark, tmp_path):
    with pytest.raises(AnalysisException):
        tables.open_collection(spark, str(tmp_path / "none"))
    assert not tables.table_exists(spark, str(tmp_path / "none"))


def test_build_and_reuse(spark, places, tmp_path):
    raw = articles.read_archives(spark, str(places / "all.tar.gz"))
    root = str(tmp_path / "build")
    options = {"cluster_counts": [3, 4], "bounds": (3, 4), "fuzziness": 1.2}
    build = run_build(spark, raw, root, **options)

    stored = tables.open_collection(spark, build.collection)
    expected = [f"{c}/{n}" for c, n, text in _articles() if len(text.split("\n\n")[1].split("\n>")[0].split()) >= 50]
    rows = stored.orderBy("metadata.doc_index").collect()
    assert [r["doc_id"] for r in rows] == expected
    assert [r["metadata"]["doc_index"] for r in rows] == list(range(len(expected)))
    assert all(np.linalg.norm(r["embedding"]) == pytest.approx(1, abs=1e-5) for r in rows)

    stored_u, centres = tables.load_clusters(spark, build.clusters)
    k = centres.count()
    u = np.array([r["memberships"] for r in stored_u.collect()])
    assert u.shape == (len(expected), k) and np.allclose(u.sum(axis=1), 1)
    assert mb.collect_centres(centres).shape[1] == 384

    summary = tables.load_summary(spark, build.summary).first()
    assert summary["n_clusters"] == k and summary["n_docs"] == len(expected)
    assert set(summary["silhouette_scores"]) == {"3", "4"}
    assert set(summary["top_docs_per_cluster"]) == {str(c) for c in range(k)}
    assert all(len(docs) == 10 for docs in summary["top_docs_per_cluster"].values())
    entropies = [d["entropy"] for d in summary["boundary_documents"]]
    assert len(entropies) == 20 and entropies == sorted(entropies, reverse=True)

    # Nothing is read or computed again when the tables are there.
    run_build(spark, None, root, reuse=True)
    run_build(spark, None, root, skip_embedding=True, skip_clustering=True)
    # Indexing again replaces the collection.
    run_build(spark, raw, root, skip_clustering=True, smoke=True)
    assert tables.open_collection(spark, build.collection).count() == len(expected)


def test_manifest(spark, tmp_path):
    rows = [(1, "a", [1.0]), (2, None, [2.0]), (2, None, [2.0]), (None, "b", None)]
    frame = lambda r: spark.createDataFrame(r, "id int, text string, v array<double>")
    one = content_digest(frame(rows))
    assert one == content_digest(frame(rows[::-1]).repartition(3)) == content_digest(frame(rows).select("v", "text", "id"))
    changed = [rows[:3], [*rows, rows[1]], rows[:1] * 3 + rows[3:], [(1, "b", [1.0]), *rows[1:3], (None, "a", None)], []]
    assert len({one, *(content_digest(frame(r)) for r in changed)}) == 6
    nulls = "a string, b string"
    assert content_digest(spark.createDataFrame([("x", None)], nulls)) != content_digest(spark.createDataFrame([(None, "x")], nulls))

    stage = lambda: Manifest(spark, str(tmp_path), "s")
    assert not stage().matches(one, {})
    stage().end(one, {"bounds": (3, 4), "smoke": False})
    assert stage().matches(one, {"smoke": False, "bounds": [3, 4]}) and not stage().matches(one, {"smoke": True, "bounds": [3, 4]})
    assert not stage().matches("other", {"smoke": False, "bounds": [3, 4]})
    # A stage that was begun and didn't end is run again.
    stage().begin()
    assert not stage().matches(one, {"smoke": False, "bounds": [3, 4]})


def test_nothing_to_build_from(spark, tmp_path):
    with pytest.raises(ValueError, match="nothing to build"):
        run_build(spark, None, str(tmp_path), reuse=True)
