import sys

from siltworks.cli import main

sys.exit(main())
