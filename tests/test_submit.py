"""Arguments of the submit targets."""

import pytest

from statflow.__main__ import arguments, sink_for
from statflow.streaming.sinks import AppendSink, DatabaseStore, FolderStore

STREAM = ["stream", "--servers", "h:1", "--topic", "t", "--checkpoint", "/c"]


def test_sinks(path):
    state = arguments([*STREAM, "--state", "--newer-only"])
    assert state.state and state.newer_only
    assert arguments(["state", "--checkpoint", "/c", "--out", "/o"]).job == "state"
    folder = sink_for(arguments([*STREAM, "--folder", path("f")]))
    assert isinstance(folder, AppendSink) and isinstance(folder.store, FolderStore)
    database = sink_for(arguments([*STREAM, "--url", "jdbc:x", "--driver", "d"]))
    assert isinstance(database.store, DatabaseStore)


def test_one_target_is_needed():
    with pytest.raises(SystemExit):
        arguments(STREAM)


def test_split_of_the_scan():
    args = arguments(
        ["enrich", "--url", "jdbc:x", "--driver", "d", "--split", "video_count", "0", "9", "4"]
    )
    assert args.split == ["video_count", "0", "9", "4"] and args.source == "channel_stats"
