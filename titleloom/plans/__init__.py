"""Plan helpers: durable intermediate tables, sized broadcasts, ranked limits, and the crawl loop."""
