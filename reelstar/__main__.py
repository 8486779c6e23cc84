import sys

from reelstar.cli import main

sys.exit(main())
