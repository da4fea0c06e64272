import json

import pytest

from tunefold.operators.catalog import MissingArtist, build_catalog
from tunefold.session import scratch_path
from tunefold.sources.pages import IncompleteLanding, check_pages_complete, read_artist_docs, read_playlist_pages

HEADER = {"id": "pl-evening", "name": "Evening walk", "snapshot_id": "rev-4"}
ITEM1 = {"added_at": "2019-02-11T07:30:00Z", "track": {
    "id": "k31", "name": "Harbour", "popularity": 12, "duration_ms": 61_500,
    "album": {"id": "al3", "name": "Low Water", "release_date": "1998-11-20", "total_tracks": 9},
    "artists": [{"id": "p4"}]}}
ITEM2 = {"added_at": "2019-03-02T18:05:00Z", "track": {
    "id": "k32", "name": "Dune", "popularity": 44, "duration_ms": 305_250,
    "album": {"id": "al5", "name": "Marram", "release_date": "2007-06", "total_tracks": 2},
    "artists": [{"id": "p9"}, {"id": "p4"}]}}
DOCS = [{"id": "p4", "name": "Quartet Nord", "genres": ["dub", "folk"], "popularity": 33},
        {"id": "p9", "name": "Ilse", "genres": ["deep house", "dub"], "popularity": 51}]


def _land(spark, lines, name):
    path = scratch_path(spark, name)
    spark.createDataFrame([(json.dumps(x),) for x in lines], "value string").coalesce(1).write.text(path)
    return path


def _page(items, total, nxt=None):
    return {**HEADER, "tracks": {"total": total, "items": items, "next": nxt}}


def _pages(spark, items_per_page):
    total = sum(map(len, items_per_page))
    lines = [_page(items, total, None if i == len(items_per_page) - 1 else f"next-{i + 1}") for i, items in enumerate(items_per_page)]
    return read_playlist_pages(spark, _land(spark, lines, "pages"))


def test_two_pages_flatten_to_tables(spark):
    pages = _pages(spark, [[ITEM1], [ITEM2, {"added_at": "2019-04-01T00:00:00Z", "track": None}]])
    check_pages_complete(pages)
    built = build_catalog(pages, read_artist_docs(spark, _land(spark, DOCS, "docs")))
    head = ("pl-evening", "Evening walk", "rev-4")
    tracks = sorted(tuple(r) for r in built.tracks.collect())
    assert tracks == [
        ("k31", "Harbour", 12, 61_500, "2019-02-11T07:30:00Z", "al3", "p4", *head),
        ("k32", "Dune", 44, 305_250, "2019-03-02T18:05:00Z", "al5", "p9, p4", *head)]
    assert sorted(tuple(r) for r in built.albums.collect()) == [
        ("al3", "Low Water", "1998-11-20", 9), ("al5", "Marram", "2007-06", 2)]
    assert sorted(tuple(r) for r in built.artists.collect()) == [
        ("p4", "Quartet Nord", "{dub,folk}", 33), ("p9", "Ilse", '{"deep house",dub}', 51)]
    assert [tuple(r) for r in built.rejected.select("reason").collect()] == [("null track",)]


FIRST, MIDDLE, LAST = _page([ITEM1], 3, "n1"), _page([ITEM2], 3, "n2"), _page([ITEM1], 3, "")


@pytest.mark.parametrize("lines", [
    [MIDDLE, LAST], [FIRST, LAST], [FIRST, MIDDLE], [FIRST, MIDDLE, LAST, LAST], [_page([ITEM1], None)],
    [_page([ITEM1], 1), _page([ITEM2], 2)],
], ids=["no first", "no middle", "no last", "one twice", "no total", "another total"])
def test_incomplete_landing_is_refused(spark, lines):
    with pytest.raises(IncompleteLanding):
        check_pages_complete(read_playlist_pages(spark, _land(spark, lines, "bad-pages")))


def test_complete_landings(spark):
    """An empty ``next`` ends a pull as NULL does; a playlist may have been pulled several times."""
    other = {**_page([ITEM1], 1), "snapshot_id": "rev-5"}
    for lines in ([FIRST, MIDDLE, LAST], [FIRST, MIDDLE, LAST] * 2, [FIRST, MIDDLE, LAST, other], [_page([], 0)]):
        check_pages_complete(read_playlist_pages(spark, _land(spark, lines, "good-pages")))


def test_missing_artist_document_fails(spark):
    pages = _pages(spark, [[ITEM1, ITEM2]])
    built = build_catalog(pages, read_artist_docs(spark, _land(spark, DOCS[:1], "docs-short")))
    for df in (built.artists, built.artists.select("artist_id")):
        with pytest.raises(Exception, match=f"{MissingArtist.__name__}.*p9"):
            df.collect()


def test_track_without_artists_keeps_null_id(spark):
    item = {"added_at": "x", "track": {"id": "k90", "name": "N", "popularity": 1, "duration_ms": 1, "album": None}}
    built = build_catalog(_pages(spark, [[item]]), read_artist_docs(spark, _land(spark, DOCS, "docs2")))
    assert [(r["track_id"], r["artist_id"]) for r in built.tracks.collect()] == [("k90", None)]
    assert built.albums.count() == 0
    assert [r["reason"] for r in built.rejected.collect()] == ["null album"]


def test_malformed_page_fails_the_read(spark):
    path = scratch_path(spark, "bad-json")
    spark.createDataFrame([(json.dumps(_page([ITEM1], 1)),),
                           ('{"id": "p", "tracks": {"items": [ {"added_at": ',)], "value string"
                          ).coalesce(1).write.text(path)
    with pytest.raises(Exception):
        read_playlist_pages(spark, path).select("id", "tracks.items").collect()


def test_flatten_struct_keeps_arrays_and_names_paths(spark):
    from tunefold.operators.nested import flatten_struct

    df = spark.createDataFrame(
        [(1, (2, (3, "x")), [1, 2])],
        "id int, a struct<b:int, c:struct<d:int, e:string>>, arr array<int>")
    flat = flatten_struct(df)
    assert flat.columns == ["id", "a_b", "a_c_d", "a_c_e", "arr"]
    assert tuple(flat.first()) == (1, 2, 3, "x", [1, 2])
