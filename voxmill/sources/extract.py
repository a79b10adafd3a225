"""Audio tracks of video files by an outside program, where there is one."""

from __future__ import annotations

import os
import shutil
import subprocess
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

#: Mono 16-bit PCM at 48 kHz.
COMMAND = ("ffmpeg", "-y", "-loglevel", "error", "-i", "{source}", "-vn", "-acodec", "pcm_s16le", "-ar", "48000", "-ac", "1", "{target}")


def extract_tracks(listing: DataFrame, folder: str, command: tuple[str, ...] = COMMAND, seconds: int = 600) -> DataFrame:
    """(name, path, status, error) of each row (path, name): success, skipped (the track is there already) or failed.

    Sources and the folder must lie where executors can open files. A track appears under its name when it is whole.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for source, name in zip(pdf["path"], pdf["name"], strict=True):
                target = os.path.join(folder, f"{name}.wav")
                part = os.path.join(folder, f".{name}.{os.getpid()}.part.wav")
                if os.path.exists(target):
                    rows.append((name, target, "skipped", None))
                    continue
                try:
                    if not shutil.which(command[0]):
                        raise FileNotFoundError(f"{command[0]} isn't installed")
                    os.makedirs(folder, exist_ok=True)
                    subprocess.run([x.format(source=source.removeprefix("file:"), target=part) for x in command], check=True, timeout=seconds, capture_output=True)
                    os.replace(part, target)
                    rows.append((name, target, "success", None))
                except Exception as e:  # one bad file doesn't end the run
                    rows.append((name, None, "failed", f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["name", "path", "status", "error"])

    return listing.select("path", "name").mapInPandas(run, "name string, path string, status string, error string")
