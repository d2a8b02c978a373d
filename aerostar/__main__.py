"""``python -m aerostar`` -- see ``aerostar.cli``."""

import sys

from aerostar.cli import main

sys.exit(main())
