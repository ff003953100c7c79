"""Start the streaming jobs (also usable with ``spark-submit``).

    python -m groundtrack JOB [JOB ...] --root PATH
        (--servers HOST:PORT | --positions DIR [--requests DIR])
        [--trigger "2 minutes" | --available-now] [--archive-sat-id ID]

JOB is ``positions``, ``requests``, ``motion``, ``tracks`` or ``live`` (closest
requests answered from the position stream itself, without an archive). With
``--servers`` the jobs read the position topics and the request topic of a
message broker and publish responses to it; with ``--positions`` /
``--requests`` they read folders of raw-record files (``value, topic,
offset``). ``--root`` is the shared folder for tables and checkpoints.
"""

from __future__ import annotations

import argparse
import sys

JOBS = ("positions", "requests", "motion", "tracks", "live")


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="groundtrack", description=__doc__.split("\n")[0])
    ap.add_argument("jobs", nargs="+", choices=JOBS, help="jobs to start")
    ap.add_argument("--root", required=True, help="shared folder for tables and checkpoints")
    ap.add_argument("--servers", help="message broker servers (host:port,...)")
    ap.add_argument("--positions", help="folder of raw position records (instead of a broker)")
    ap.add_argument("--requests", help="folder of raw request records (instead of a broker)")
    ap.add_argument("--trigger", help='processing-time interval, e.g. "2 minutes"')
    ap.add_argument("--available-now", action="store_true", help="process what is there, then stop")
    ap.add_argument("--archive-sat-id", help="archive only this object (default: all)")
    ap.add_argument("--cell-deg", type=float, help="first cells of the closest-object search, in degrees of arc (default: by the number of objects)")
    ap.add_argument("--look-back", type=int, help="requests: oldest fix seen, in seconds (default: any; live: 3600)")
    ap.add_argument("--required-satellites", type=int, help="requests: overlap only where so many objects are seen")
    ap.add_argument("--max-files-per-trigger", type=int, help="file sources: files of a micro-batch (default: all)")
    ap.add_argument("--arrival-time", action="store_true", help="tracks: windows by arrival time")
    ap.add_argument("--redraw-every", type=float, default=120, help="tracks: seconds between maps, at least")
    ap.add_argument("--final-windows", action="store_true",
                    help="tracks: write each window once, when final (append mode)")
    a = ap.parse_args(argv)
    if not a.servers and not a.positions:
        ap.error("give --servers or --positions")

    from groundtrack.session import build_session
    from groundtrack.streaming import jobs, sources

    spark = build_session(app="groundtrack-jobs")
    trigger = ({"availableNow": True} if a.available_now
               else {"processingTime": a.trigger} if a.trigger else None)

    def positions():
        if a.servers:
            return sources.read_positions(spark, a.servers)
        return sources.read_files(spark, a.positions, max_files_per_trigger=a.max_files_per_trigger)

    def requests():
        if a.servers:
            return sources.read_requests(spark, a.servers)
        if not a.requests:
            ap.error("the requests job needs --servers or --requests")
        return sources.read_files(spark, a.requests, max_files_per_trigger=a.max_files_per_trigger)

    queries = []
    # positions first: the other jobs read what it archives
    for job in sorted(set(a.jobs), key=JOBS.index):
        if job == "positions":
            queries += jobs.start_positions(positions(), a.root, a.archive_sat_id, trigger)
        elif job == "requests":
            queries.append(jobs.start_requests(requests(), a.root, a.servers, trigger, a.cell_deg,
                                               a.look_back, a.required_satellites))
        elif job == "motion":
            queries.append(jobs.start_motion(positions(), a.root, a.servers, trigger=trigger))
        elif job == "tracks":
            queries.append(jobs.start_tracks(positions(), a.root, trigger=trigger, final_only=a.final_windows,
                                             redraw_every_s=a.redraw_every, arrival_time=a.arrival_time))
        elif job == "live":
            queries.append(jobs.start_live(positions(), requests(), a.root, a.look_back or 3600, a.servers, trigger))
        if a.available_now:           # one after another, so requests see the archive
            for q in queries:
                q.awaitTermination()
    failed = wait_all(spark, queries)
    if failed is not None:
        print(failed, file=sys.stderr)
    return int(failed is not None)


def wait_all(spark, queries):
    """Wait until one of the queries fails (its error; the others are stopped)
    or all have ended (None)."""
    while True:
        for q in queries:
            if not q.isActive and q.exception():
                for other in queries:
                    other.stop()
                return q.exception()
        if not any(q.isActive for q in queries):
            return None
        spark.streams.resetTerminated()
        if any(q.isActive for q in queries):
            try:
                spark.streams.awaitAnyTermination(60)
            except Exception:  # noqa: BLE001 - the loop above finds whose it was
                pass


if __name__ == "__main__":
    sys.exit(main())
