"""The worklist as a stream, fed file by file, late and repeatedly."""

import datetime as dt
import random

from conftest import rows

from parcelworks.operators.tracking import tracking_worklist
from parcelworks.streaming import worklist

D = dt.date
POLLS = [D(2024, 3, 1), D(2024, 3, 31), D(2024, 4, 30)]
SCHEMA = "awb_no string, time timestamp, mapped_status string"


def _run(spark, folder, name):
    stream = spark.readStream.schema(SCHEMA).parquet(f"{folder}/in")
    due = worklist.due_keys(stream, POLLS, delay="3 days")
    query = due.writeStream.format("parquet").option("path", f"{folder}/{name}").option("checkpointLocation", f"{folder}/chk")
    run = query.trigger(availableNow=True).start()
    run.awaitTermination()
    return run.lastProgress["stateOperators"][0]["numRowsTotal"]


def test_stream_gives_the_batch_worklist(spark, tmp_path):
    r = random.Random(8)
    start = dt.datetime(2024, 1, 1)
    lines, updates = [], []
    for k in range(60):
        awb, born = f"A{k}", r.randint(0, 150)
        for _ in range(r.randint(0, 3)):
            lines.append((awb, start + dt.timedelta(days=born + r.choice([0, 0, 5, 40]), hours=r.choice([0, 13]))))
        if k % 5:
            updates.append((awb, start + dt.timedelta(days=born + 1), "active"))
            if k % 3:
                updates.append((awb, start + dt.timedelta(days=born + r.choice([4, 30, 59, 60, 61]), hours=r.choice([0, 7])), "status_completed"))
    events = worklist.line_events(spark.createDataFrame([("`" + a, t) for a, t in lines] + [(" ", start), (None, start)], "tracking_number string, order_date timestamp"))
    events = events.unionByName(worklist.status_events(spark.createDataFrame([(a, s, t) for a, t, s in updates], "awb_no string, mapped_status string, at timestamp"), "at"))
    table = [(e["awb_no"], e["time"], e["mapped_status"]) for e in events.collect()]
    assert len(table) == len(lines) + len(updates)
    # Events land in order of time, each up to three days late, and one in five twice.
    landed = sorted((t + dt.timedelta(hours=r.randint(0, 70)), (a, t, s)) for a, t, s in table for _ in range(1 + (r.random() < 0.2)))
    folder = str(tmp_path)
    cuts = [0, len(landed) // 3, len(landed) // 2, len(landed)]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        spark.createDataFrame([e for _, e in landed[a:b]], SCHEMA).repartition(2).write.mode("append").parquet(f"{folder}/in")
        _run(spark, folder, "due")
    spark.createDataFrame([("heartbeat", dt.datetime(2024, 12, 1), "status_completed")], SCHEMA).write.mode("append").parquet(f"{folder}/in")
    left = _run(spark, folder, "due")
    got = rows(spark.read.parquet(f"{folder}/due"), "awb_no", "poll_day")
    want = []
    for poll in POLLS:
        noon = dt.datetime.combine(poll, dt.time())
        recent = [(a,) for a, t in lines if noon - dt.timedelta(days=30) <= dt.datetime.combine(t.date(), dt.time()) < noon]
        last = {}
        for a, t, s in sorted(updates, key=lambda u: u[1]):
            if t < noon:
                last[a] = s
        batch = tracking_worklist(
            spark.createDataFrame(recent, "tracking_number string"),
            spark.createDataFrame(list(last.items()), "awb_no string, mapped_status string"),
            "awb_no",
        )
        want += [(a, poll) for (a,) in rows(batch)]
    assert got == sorted(want, key=repr) and len({p for _, p in got}) == 3
    # Nothing is left of the shipments once the last poll is over.
    assert left == 0


def test_shipments_share_the_state_of_their_block(spark, tmp_path):
    at = dt.datetime(2024, 2, 20)
    table = [(f"A{k}", at, None) for k in range(300)] + [(f"A{k}", at, "active") for k in range(0, 300, 3)]
    spark.createDataFrame(table, SCHEMA).write.parquet(f"{tmp_path}/in")

    def run():
        stream = spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/in")
        due = worklist.due_keys(stream, POLLS, delay="3 days", blocks=4)
        query = due.writeStream.format("parquet").option("path", f"{tmp_path}/due").option("checkpointLocation", f"{tmp_path}/chk")
        going = query.trigger(availableNow=True).start()
        going.awaitTermination()
        return going.lastProgress["stateOperators"][0]["numRowsTotal"]

    assert run() == 4
    # A later event of one shipment makes the others of all blocks due.
    spark.createDataFrame([("A1", dt.datetime(2024, 4, 5), "status_completed")], SCHEMA).write.mode("append").parquet(f"{tmp_path}/in")
    assert run() == 4
    got = rows(spark.read.parquet(f"{tmp_path}/due"), "awb_no", "poll_day")
    want = [(f"A{k}", POLLS[0]) for k in range(300)] + [(f"A{k}", POLLS[1]) for k in range(0, 300, 3)]
    assert got == sorted(want, key=repr)
