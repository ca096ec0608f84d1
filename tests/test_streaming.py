import datetime as dt
import threading

import pytest
from pyspark.sql import functions as F

from muster.config import MailingConfig
from muster.plans import approval
from muster.sources.ledger import Ledger
from muster.sources.scratch import cut, delete, intermediate
from muster.streaming.approval import Waiting, changed_events, changed_timeslots, mail_approvals
from tests.helpers import DS, EVENT, RUN_TS, at, rows, table, world

CFG = MailingConfig(ds=DS, mailing_name="event_approval")


def test_stream_equals_batch_and_repeats_are_harmless(spark, tmp_path):
    slots = [dict(id=i, event_id=i, start_date=at(20, 20)) for i in range(1, 8)]
    tables = world(spark, [], slots)
    arrived, ledger = str(tmp_path / "in"), Ledger(spark, str(tmp_path / "l")).init("event_approval")

    def arrive(*events):
        table(spark, "org_events", *events, **EVENT).coalesce(1).write.mode("append").parquet(arrived)

    def run(checkpoint):
        query = mail_approvals(changed_events(spark, arrived, 1), lambda: tables, ledger, CFG,
                               str(tmp_path / checkpoint), lambda: RUN_TS)
        query.awaitTermination()
        return rows(ledger.schedulings(), "email", "secondary_id")

    first, second = dict(id=1), dict(id=2, approval_status="PENDING")
    arrive(first, second)
    assert run("c") == [("h@x.org", 1)]
    # Event 1 changed once more; 2 was approved; 3 came twice in one file.
    later = [dict(id=1, title="new"), dict(id=2, reviewed_date=at(11)), dict(id=3),
             dict(id=3, reviewed_date=at(11), title="late")]
    arrive(*later)
    assert run("c") == [("h@x.org", 1), ("h@x.org", 2), ("h@x.org", 3)]
    before = rows(ledger.schedulings()), rows(ledger.payloads("event_approval"))
    assert run("c") == run("started over")
    assert before == (rows(ledger.schedulings()), rows(ledger.payloads("event_approval")))
    titles = rows(ledger.payloads("event_approval"), "secondary_id", "event_title")
    assert titles == [(1, "t"), (2, "t"), (3, "late")]

    everything = table(spark, "org_events", first, later[1], later[3], **EVENT)
    batch = Ledger(spark, str(tmp_path / "b")).init("event_approval")
    approval.schedule_approvals({**tables, "org_events": everything}, batch, CFG, RUN_TS)
    assert rows(batch.schedulings()) == before[0]


class Feed:
    """Events and timeslots that arrive as files, and the stream over both."""

    def __init__(self, spark, folder):
        self.spark, self.folder = spark, folder
        self.ledger = Ledger(spark, str(folder / "ledger")).init("event_approval")
        for name in ("org_events", "timeslots"):
            (folder / name).mkdir()

    def arrive(self, name, *new):
        defaults = EVENT if name == "org_events" else {}
        frame = table(self.spark, name, *new, **defaults).coalesce(1)
        frame.write.mode("append").parquet(str(self.folder / name))

    def run(self, checkpoint="c", known=()):
        query = mail_approvals(
            changed_events(self.spark, str(self.folder / "org_events"), 1),
            lambda: {"timeslots": table(self.spark, "timeslots", *known)},
            self.ledger, CFG, str(self.folder / checkpoint), lambda: RUN_TS,
            changed_timeslots(self.spark, str(self.folder / "timeslots"), 1),
        )
        query.awaitTermination()
        assert query.exception() is None
        return rows(self.ledger.schedulings(), "email", "secondary_id")

    def batch(self):
        """The batch job on all that has arrived."""
        ledger = Ledger(self.spark, str(self.folder / "batch")).init("event_approval")
        read = {name: self.spark.read.parquet(str(self.folder / name)) for name in ("org_events", "timeslots")}
        approval.schedule_approvals(read, ledger, CFG, RUN_TS)
        return rows(ledger.schedulings(), "email", "secondary_id")


def test_a_timeslot_wakes_an_event_three_batches_later(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.arrive("org_events", dict(id=1), dict(id=2))
    assert feed.run() == []
    feed.arrive("timeslots", dict(id=30, event_id=3, start_date=at(20, 20)))
    assert feed.run() == []
    feed.arrive("org_events", dict(id=4))
    assert feed.run() == []
    feed.arrive("timeslots", dict(id=10, event_id=1, start_date=at(20, 20)))
    assert feed.run() == [("h@x.org", 1)]
    # The other way round: the timeslot of event 3 is there already.
    feed.arrive("org_events", dict(id=3))
    assert feed.run() == [("h@x.org", 1), ("h@x.org", 3)]
    payloads = rows(feed.ledger.payloads("event_approval"))
    # More timeslots of events that were mailed about, and a replay of everything.
    feed.arrive("timeslots", dict(id=11, event_id=1, start_date=at(21, 20)))
    assert feed.run() == feed.run("from the start") == [("h@x.org", 1), ("h@x.org", 3)]
    assert rows(feed.ledger.payloads("event_approval")) == payloads
    assert feed.batch() == [("h@x.org", 1), ("h@x.org", 3)]


def test_a_waiting_event_counts_as_it_last_arrived(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.arrive("org_events", dict(id=1, title="old"), dict(id=2), dict(id=3, approval_status="PENDING"))
    assert feed.run() == []
    feed.arrive("org_events", dict(id=1, title="new"), dict(id=2, deleted_date=at(11)))
    assert feed.run() == []
    feed.arrive("timeslots", *[dict(id=i, event_id=i, start_date=at(20, 20)) for i in (1, 2, 3)])
    assert feed.run() == [("h@x.org", 1)]
    assert rows(feed.ledger.payloads("event_approval"), "event_title") == [("new",)]
    feed.arrive("org_events", dict(id=3))
    assert feed.run() == [("h@x.org", 1), ("h@x.org", 3)]


def test_timeslots_of_the_past_wake_nobody_and_known_ones_count(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.arrive("org_events", dict(id=1), dict(id=2))
    feed.arrive("timeslots", dict(id=10, event_id=1, start_date=at(2)), dict(id=None, event_id=None))
    assert feed.run() == []
    feed.arrive("org_events", dict(id=2, title="again"))
    assert feed.run(known=[dict(id=20, event_id=2, start_date=at(20, 20))]) == [("h@x.org", 2)]


def test_what_is_done_with_is_forgotten(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.arrive("org_events", dict(id=1), dict(id=2), dict(id=3, approval_status="PENDING"))
    feed.arrive("timeslots", dict(id=10, event_id=1, start_date=at(20, 20)))
    assert feed.run() == [("h@x.org", 1)]
    waiting = Waiting(feed.ledger, CFG)
    assert rows(waiting.events.latest(), "id") == [(1,), (2,), (3,)]
    waiting.tidy()
    assert rows(waiting.events.latest(), "id") == [(2,)]
    later = Waiting(feed.ledger, CFG.on(dt.date(2020, 2, 25)))
    later.tidy()
    assert later.timeslots.latest().count() == 0
    # A generation that was not finished does not count.
    unfinished = f"{later.events.folder}/generation-9"
    later.events.latest().limit(0).write.parquet(unfinished)
    delete(spark, f"{unfinished}/_SUCCESS")
    assert rows(later.events.latest(), "id") == [(2,)]


def test_clean_up_keeps_to_its_thread(spark):
    """A frame cut on another thread outlives the block that this thread has open."""
    made = {}
    with intermediate(spark):
        own = cut(spark.range(3))
        thread = threading.Thread(target=lambda: made.update(other=cut(spark.range(4))))
        thread.start()
        thread.join()
        with intermediate(spark):
            inner = cut(spark.range(5))
        with pytest.raises(Exception, match="FILE_NOT_EXIST|does not exist"):
            inner.collect()
        assert own.count() == 3
    with pytest.raises(Exception, match="FILE_NOT_EXIST|does not exist"):
        own.collect()
    assert made["other"].count() == 4


def test_tables_arrive_in_files_of_bounded_rows(spark, monkeypatch):
    import __spark_entry__ as entry

    monkeypatch.setattr(entry, "ARRIVING_ROWS", 10)
    slots = table(spark, "timeslots", *[dict(id=i, event_id=i) for i in range(120)])
    folder, files = entry._arrived({"timeslots": slots}, spark, "timeslots", 3)
    assert files == 4
    sizes = spark.read.parquet(folder).groupBy(F.input_file_name()).count().collect()
    assert len(sizes) == 12 and max(row[1] for row in sizes) <= 20
