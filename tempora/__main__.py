import sys

from tempora.cli import main

sys.exit(main())
