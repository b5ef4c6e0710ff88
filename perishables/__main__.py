import sys

from perishables.plans.cli import main

sys.exit(main())
