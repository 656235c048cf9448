"""What training on the driver takes and leaves: the driver's memory is small and serves all later stages."""
import subprocess
import sys
from pathlib import Path

import numpy as np

from reelspark.llm import toxicity

MEASURE = """
import random, re, threading, time
import numpy as np
from reelspark.llm import toxicity
def held():
    return int(re.search(r"RssAnon:\\s+(\\d+)", open("/proc/self/status").read())[1]) / 1024
rng = random.Random(3)
known = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(3, 10))) for _ in range(6000)]
texts = [" ".join(rng.choices(known, k=400)) for _ in range(1200)]
label = np.arange(1200) % 2
before, most, over = held(), [0], []
def look():
    while not over:
        most[0] = max(most[0], held())
        time.sleep(0.005)
watch = threading.Thread(target=look)
watch.start()
toxicity.fit(texts, label, toxicity.BUCKETS, mean_rounds=2, top_rounds=2)
over.append(1)
watch.join()
print(most[0] - before)
"""


def test_training_holds_little():
    """3 MB of text: 110 MB; 165 MB when all subwords of whole texts were held in 12 bytes each."""
    got = subprocess.run([sys.executable, "-c", MEASURE], cwd=Path(__file__).parents[2], capture_output=True, text=True, timeout=300)
    assert got.returncode == 0, got.stderr[-2000:]
    assert float(got.stdout) < 140


def test_training_on_texts_without_words():
    for texts in (["", ""], [" ", "!"], ["a b", ""]):
        slope, intercept = toxicity.fit(texts, np.array([1, 0]), 1 << 12)
        assert not slope.any() and intercept == 0
