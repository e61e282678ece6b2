"""What the operators share."""

import gc
import re
import time
from pathlib import Path

from clickweir.llm import common


def held_mb(process="self") -> float:
    return int(re.search(r"Pss_Anon:\s+(\d+)", Path(f"/proc/{process}/smaps_rollup").read_text())[1]) / 1024


def test_tidy_gives_freed_memory_back(spark):
    blocks = [b"x" * 50_000 for _ in range(3000)]
    last = b"y" * 50_000  # keeps the C library from giving back the end of its heap by itself
    full = held_mb()
    blocks.clear()
    common.tidy(spark)
    assert len(last) and full - held_mb() > 100


def test_tidy_gives_back_what_the_jvm_has_freed_outside_its_heap(spark):
    jvm = spark.sparkContext._jvm
    process = jvm.java.lang.ProcessHandle.current().pid()
    blocks = [jvm.java.nio.ByteBuffer.allocateDirect(50_000) for _ in range(3000)]
    last = jvm.java.nio.ByteBuffer.allocateDirect(50_000)  # keeps the C library from giving back the end of its heap by itself
    full = held_mb(process)
    blocks.clear()
    gc.collect()
    for _ in range(2):
        jvm.System.gc()
        time.sleep(0.5)
    common.tidy(spark)
    assert last is not None and full - held_mb(process) > 100
