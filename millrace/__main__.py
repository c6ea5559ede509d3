"""``python -m millrace --events FOLDER --checkpoint FOLDER name=value ...``: consume change-log files."""

from __future__ import annotations

import argparse
from threading import Event, Thread

from pyspark.sql import SparkSession

from millrace.options import Options, mask_secrets
from millrace.streaming.consumer import Consumer, event_stream


def main(args: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="millrace", description=__doc__)
    parser.add_argument("--events", required=True, help="folder of JSON lines: destination, key, value")
    parser.add_argument("--checkpoint", required=True)
    parser.add_argument("--follow", action="store_true", help="go on as files arrive")
    parser.add_argument("option", nargs="*", help="name=value")
    got = parser.parse_args(args)
    config = dict(o.split("=", 1) for o in got.option)
    print("options:", mask_secrets(config), flush=True)
    runner = Runner(config, got.events, got.checkpoint, got.follow)
    try:
        runner.run()
    except KeyboardInterrupt:
        runner.stop()


class Runner:
    """A consumer of a folder of change-log files, here or in a thread of its own."""

    def __init__(self, config: dict[str, str], events: str, checkpoint: str, follow: bool = False):
        self.options, self.events, self.checkpoint, self.follow = Options.from_properties(config), events, checkpoint, follow
        self.stopped = Event()
        self.failure: BaseException | None = None
        self._thread: Thread | None = None

    def run(self) -> None:
        builder = SparkSession.builder.appName("millrace").config("spark.sql.session.timeZone", "UTC")
        for name, value in self.options.spark_config.items():
            builder = builder.config(name, value)
        spark = builder.getOrCreate()
        consumer = Consumer(spark, self.options)
        if self.follow:
            consumer.follow(self.events, self.checkpoint, self.stopped)
        else:
            consumer.start(event_stream(spark, self.events), self.checkpoint, available_now=True).awaitTermination()

    def run_async(self) -> Thread:
        """Run in a thread; ``failure`` holds what ended it, if anything did."""

        def guarded() -> None:
            try:
                self.run()
            except BaseException as e:
                self.failure = e

        self._thread = Thread(target=guarded, daemon=True)
        self._thread.start()
        return self._thread

    def stop(self, timeout_s: float | None = None) -> None:
        """End after the batch at work."""
        self.stopped.set()
        if self._thread:
            self._thread.join(timeout_s)


if __name__ == "__main__":
    main()
