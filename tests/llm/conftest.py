import os
import sys
from pathlib import Path

ROOT = str(Path(__file__).resolve().parents[2])
sys.path[:0] = [ROOT]
# Python workers import the operators too
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, os.environ.get("PYTHONPATH", "")])
