"""Script for spark-submit: loads one run date and rebuilds the layers.

    spark-submit --py-files rainroute.zip submit.py --lake /data/lake --run-date 2024-08-24 \
        --source viagens_onibus=/data/in/trips --source clima_pluviometria=/data/in/rain
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rainroute.__main__ import main  # noqa: E402

if __name__ == "__main__":
    main()
