from strata.plans.entrypoints import main

main()
