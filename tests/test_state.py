import json

import pytest

from siltworks.sources import sinks
from siltworks.sources.state import KEPT, StateConflict, StateFile


def test_versions_and_old_states(spark, tmp_path):
    path = str(tmp_path / "s" / "state.json")
    assert StateFile(spark, path).read() == {}
    (tmp_path / "s").mkdir()
    (tmp_path / "s" / "state.json").write_text(json.dumps({"file_hashes": {"a": "é"}}), encoding="utf-8")
    assert sinks.load_state(spark, path) == {"hashes": {"a": "é"}}
    state = StateFile(spark, path)
    for i in range(KEPT + 5):
        state.update(lambda s, i=i: s | {"n": i})
    assert sinks.load_state(spark, path) == {"hashes": {"a": "é"}, "n": KEPT + 4} and len(state.versions()) == KEPT


def test_a_second_writer_is_told(spark, tmp_path):
    path = str(tmp_path / "state.json")
    sinks.save_state(spark, path, {"a": 1})
    one, two = StateFile(spark, path), StateFile(spark, path)
    read = one.read(), two.read()
    one.commit(read[0] | {"one": 1})
    with pytest.raises(StateConflict):
        two.commit(read[1] | {"two": 2})
    assert sinks.load_state(spark, path) == {"a": 1, "one": 1}
    # update() begins again with what the other wrote
    two.update(lambda s: s | {"two": 2})
    assert sinks.load_state(spark, path) == {"a": 1, "one": 1, "two": 2}


def test_writers_that_meet_lose_nothing(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    path = str(tmp_path / "state.json")
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda i: StateFile(spark, path).update(lambda s: s | {str(i): i}, tries=100), range(12)))
    assert sinks.load_state(spark, path) == {str(i): i for i in range(12)}


def test_a_crash_between_the_steps_loses_nothing(spark, tmp_path):
    path = str(tmp_path / "state.json")
    sinks.save_state(spark, path, {"a": 1})
    state = StateFile(spark, path)
    state.read()
    crashed = StateFile(spark, path)
    crashed.read()
    crashed.context = lambda: (_ for _ in ()).throw(RuntimeError("killed before the rename"))
    with pytest.raises(RuntimeError):
        crashed.commit({"a": 2})
    assert sinks.load_state(spark, path) == {"a": 1}
    assert state.commit({"a": 3}) == 2 and sinks.load_state(spark, path) == {"a": 3}
    # a version that was cut off, as on a store without atomic renames, is passed over
    (tmp_path / "state.json.versions" / f"{3:012d}.json").write_text('{"a": ')
    assert sinks.load_state(spark, path) == {"a": 3}
    sinks.save_state(spark, path, {"a": 4})
    assert sinks.load_state(spark, path) == {"a": 4}
