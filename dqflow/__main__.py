import sys

from dqflow.plans.cli import main

sys.exit(main())
