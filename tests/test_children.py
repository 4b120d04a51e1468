"""The runner's rules with real child processes."""

from __future__ import annotations

import sys
import time

from tidemark.orchestration import Job, Runner, drive


def child(code: str):
    return [sys.executable, "-S", "-c", code]


def test_children_run_by_the_rules(tmp_path):
    log = tmp_path / "log"

    def command(job: Job) -> list[str]:
        body = {"ok": "", "bad": "import sys; sys.exit(3)"}.get(job.name.split("-")[0], "")
        return child(f"import time; open({str(log)!r}, 'a').write('+{job.name} '); time.sleep(0.3); open({str(log)!r}, 'a').write('-{job.name} '); {body}")

    runner = Runner(most=2)
    done = drive(runner, [Job("ok-1"), Job("bad-1"), Job("ok-2"), Job("ok-1")], command, poll=0.02)
    assert sorted(done) == [("bad-1", 3), ("ok-1", 0), ("ok-1", 0), ("ok-2", 0)]
    live = most = 0
    for x in log.read_text().split():
        live += 1 if x[0] == "+" else -1
        most = max(most, live)
    assert most <= 2 and runner.live == {} and "bad-1" in runner.resting and "ok-1" not in runner.resting


def test_a_child_that_wont_end_is_ended():
    began = time.monotonic()
    done = drive(Runner(), [Job("deaf")], lambda _: child("import time; time.sleep(60)"), poll=0.02, patience=0.5)
    assert done[0][0] == "deaf" and done[0][1] != 0 and time.monotonic() - began < 20
