from .plans.jobs import main

main()
