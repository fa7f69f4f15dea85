import os
import sys
from pathlib import Path

# Many threads for small matrices beside a JVM take longer than one.
os.environ.setdefault("OPENBLAS_NUM_THREADS", "1")
sys.path.insert(0, str(Path(__file__).resolve().parent))
