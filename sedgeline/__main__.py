import sys

from .plans.documents import main

sys.exit(main())
