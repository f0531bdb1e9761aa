"""The landing zone as a stream: each file once, unknown fields kept, odd lines set aside."""

import json

from statflow.sources import landing
from statflow.streaming import run
from statflow.streaming.sinks import AppendSink, FolderStore


def write(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    text = [line if isinstance(line, str) else json.dumps(line) for line in lines]
    (folder / name).write_text("\n".join(text) + "\n", encoding="utf-8")


def test_new_files_only_and_new_fields(spark, tmp_path):
    zone, sink = tmp_path / "zone", AppendSink(FolderStore(str(tmp_path / "sink")), "items", "zone")
    seen = []

    def store(batch, batch_id):
        seen.append(batch.count())
        sink(batch, batch_id)

    def deliver(name, *lines):
        write(zone, name, *lines)
        items = landing.landed_items(landing.stream_replies(spark, str(zone)))
        run.start(items, store, str(tmp_path / "checkpoint"), trigger=None).awaitTermination()
        return sink.read(spark, landing.LANDED)

    deliver("1.json", {"items": [{"id": "a", "statistics": {"viewCount": "7"}}, {"id": "b"}]})
    items = deliver("2.json", {"items": [{"id": "a", "statistics": {"viewCount": "9", "shares": 3}}]})
    assert seen == [2, 1]
    fields = {"views": ("$.statistics.viewCount", "bigint"), "shares": ("$.statistics.shares", "int")}
    got = sorted(landing.typed(items, fields).drop(landing.FILE).collect(), key=str)
    assert [tuple(r) for r in got] == [("a", 7, None), ("a", 9, 3), ("b", None, None)]
    names = {r.name: (r.n, r.first_file[-6:]) for r in landing.field_names(items, "$.statistics").collect()}
    assert names == {"viewCount": (2, "1.json"), "shares": (1, "2.json")}


def test_odd_lines(spark, tmp_path):
    zone = tmp_path / "zone"
    write(
        zone,
        "odd.json",
        "",
        "   ",
        '{"items": [',
        "null",
        "[]",
        '{"items": null}',
        '{"items": {"id": "x"}}',
        '{"items": []}',
        '{"items": ["text", null, {"id": null}, {"id": 5}, {"id": "ü", "n": 1.5, "id2": {"id": "y"}}]}',
    )
    replies = landing.batch_replies(spark, str(zone))
    assert [r.text for r in landing.unreadable(replies).collect()] == ['{"items": [']
    items = landing.landed_items(replies)
    assert sorted(str(r.id) for r in items.collect()) == ["5", "None", "None", "None", "ü"]
    wrong = {"n": ("$.n", "double"), "as_list": ("$.n", "array<string>"), "none": ("$.missing.deep", "int")}
    assert [tuple(r)[2:] for r in landing.typed(items.where("id = 'ü'"), wrong).collect()] == [(1.5, None, None)]
    # elements that are no objects have no fields
    assert {r.name: r.n for r in landing.field_names(items).collect()} == {"id": 3, "n": 1, "id2": 1}


def test_empty_zone(spark, tmp_path):
    (tmp_path / "zone").mkdir()
    items = landing.landed_items(landing.batch_replies(spark, str(tmp_path / "zone")))
    assert items.count() == 0 and landing.field_names(items).count() == 0
