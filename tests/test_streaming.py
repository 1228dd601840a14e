import os

from helpers import HEADER, THREE_ROWS, write_text
from waybatch.sinks.routes import read_routes
from waybatch.streaming.ingest import start_route_stream

LINES = THREE_ROWS.splitlines(keepends=True)[1:]


def test_stream_routes_new_files(spark, tmp_dir):
    write_text(f"{tmp_dir}/in/a.csv", HEADER + LINES[0])
    write_text(f"{tmp_dir}/in/b.csv", HEADER + LINES[1])
    q = start_route_stream(spark, f"{tmp_dir}/in", f"{tmp_dir}/routes", f"{tmp_dir}/ckpt", batch_size=10)
    q.awaitTermination(120)
    rows = read_routes(spark, f"{tmp_dir}/routes").orderBy("route_key").collect()
    assert sorted(r.delivery_id for r in rows) == [1, 2]
    # a restart sees no new file and appends nothing
    q = start_route_stream(spark, f"{tmp_dir}/in", f"{tmp_dir}/routes", f"{tmp_dir}/ckpt", batch_size=10)
    q.awaitTermination(120)
    assert read_routes(spark, f"{tmp_dir}/routes").count() == 2


def test_stream_restart_picks_up_only_new_files(spark, tmp_dir):
    write_text(f"{tmp_dir}/in/a.csv", HEADER + LINES[0])
    q = start_route_stream(spark, f"{tmp_dir}/in", f"{tmp_dir}/routes", f"{tmp_dir}/ckpt", batch_size=10, mode="input_order")
    q.awaitTermination(120)
    write_text(f"{tmp_dir}/in/b.csv", HEADER + LINES[1] + LINES[2])
    q = start_route_stream(spark, f"{tmp_dir}/in", f"{tmp_dir}/routes", f"{tmp_dir}/ckpt", batch_size=10, mode="input_order")
    q.awaitTermination(120)
    rows = read_routes(spark, f"{tmp_dir}/routes").orderBy("route_key").collect()
    assert [(r.route_key, r.delivery_id) for r in rows] == [(1, 1), (2, 2), (3, 3)]


def test_stream_reads_columns_by_name_and_skips_bad_files(spark, tmp_dir):
    names = HEADER.strip().split(",")
    values = dict(zip(names, LINES[0].strip().split(",")))
    turned = names[::-1]
    write_text(f"{tmp_dir}/in/a.csv", ",".join(turned) + "\n" + ",".join(values[c] for c in turned) + "\n")
    write_text(f"{tmp_dir}/in/b.csv", HEADER + LINES[1].strip() + ",extra\n")
    q = start_route_stream(spark, f"{tmp_dir}/in", f"{tmp_dir}/routes", f"{tmp_dir}/ckpt", batch_size=10)
    q.awaitTermination(120)
    rows = read_routes(spark, f"{tmp_dir}/routes").collect()
    assert [(r.delivery_id, r.pickup_lat) for r in rows] == [(1, float(values["pickup_lat"]))]


def test_an_epoch_that_runs_again_is_stored_once(spark, tmp_dir):
    write_text(f"{tmp_dir}/in/a.csv", HEADER + LINES[0])
    args = (spark, f"{tmp_dir}/in", f"{tmp_dir}/routes", f"{tmp_dir}/ckpt")
    start_route_stream(*args, batch_size=10).awaitTermination(120)
    for name in os.listdir(f"{tmp_dir}/ckpt/commits"):  # as if the stream had died before its commit
        os.remove(f"{tmp_dir}/ckpt/commits/{name}")
    start_route_stream(*args, batch_size=10).awaitTermination(120)
    assert read_routes(spark, f"{tmp_dir}/routes").count() == 1
