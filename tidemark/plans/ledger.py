"""What a job has finished, so that a rerun after a failure goes on where it stopped.

A step's entry, one small file, names the inputs its outputs were made from. The entry is removed
before the step runs and written when all its outputs are there, so an interrupted step is run again.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

from pyspark.sql import SparkSession

from tidemark.sources.files import read_whole, remove_folder, write_whole


class Ledger:
    def __init__(self, spark: SparkSession, folder: str, resume: bool):
        self.spark, self.folder, self.resume = spark, folder, resume
        self.skipped: list[str] = []

    def run(self, step: str, inputs: object, action: Callable[[], object]) -> None:
        """Run ``action`` unless, resuming, the step's last finished run had the same inputs."""
        path = f"{self.folder}/{step}.json"
        digest = hashlib.sha256(json.dumps(inputs, sort_keys=True).encode()).hexdigest()
        if self.resume and read_whole(self.spark, path) == digest:
            self.skipped.append(step)
            return
        remove_folder(self.spark, path)
        action()
        write_whole(self.spark, path, digest)
